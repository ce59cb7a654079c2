"""Rule tables of the SQL oracle, written out as rows and joined by range.

Spark side, so a wrong cut or label there shows.  A band holds values over ``above`` up to ``upto``
(recency) or from ``least`` up to but not ``below`` (all others).
"""

from __future__ import annotations

FAR = 1_000_000_000

RECENCY_SCORES = f"""(VALUES (5, -{FAR}, 30), (4, 30, 60), (3, 60, 90), (2, 90, 180), (1, 180, {FAR}))
    AS recency_band(score, above, upto)"""
FREQUENCY_SCORES = f"""(VALUES (5, 20, {FAR}), (4, 15, 20), (3, 10, 15), (2, 5, 10), (1, -{FAR}, 5))
    AS frequency_band(score, least, below)"""
MARKETING_MONEY_SCORES = f"""(VALUES (5, 10000, {FAR}), (4, 5000, 10000), (3, 2000, 5000), (2, 500, 2000), (1, -{FAR}, 500))
    AS money_band(score, least, below)"""
ML_MONEY_SCORES = f"""(VALUES (5, 1000, {FAR}), (4, 750, 1000), (3, 500, 750), (2, 250, 500), (1, -{FAR}, 250))
    AS money_band(score, least, below)"""

# Label and the scores it covers (recency, frequency, money: least and most); earlier rows win.
MARKETING_SEGMENT_ROWS = """(VALUES
    (1, 4, 5, 4, 5, 4, 5, 'Champions'), (2, 3, 5, 3, 5, 3, 5, 'Loyal Customers'), (3, 4, 5, 1, 2, 3, 5, 'Potential Loyalists'),
    (4, 4, 5, 1, 2, 1, 2, 'New Customers'), (5, 3, 5, 2, 5, 3, 5, 'Promising'), (6, 1, 2, 3, 5, 3, 5, 'Need Attention'),
    (7, 1, 2, 2, 5, 2, 5, 'About to Sleep'), (8, 1, 2, 1, 2, 2, 5, 'At Risk'), (9, 1, 2, 1, 2, 1, 2, 'Cannot Lose Them'),
    (10, 1, 5, 1, 5, 1, 5, 'Others'))"""
ML_SEGMENT_ROWS = """(VALUES
    (1, 4, 5, 4, 5, 4, 5, 'Champions'), (2, 3, 5, 3, 5, 3, 5, 'Loyal Customers'), (3, 4, 5, 1, 2, 1, 2, 'New Customers'),
    (4, 3, 5, 2, 5, 2, 5, 'Potential Loyalists'), (5, 2, 5, 3, 5, 3, 5, 'At Risk'), (6, 1, 2, 2, 5, 2, 5, 'Cannot Lose Them'),
    (7, 1, 2, 1, 2, 3, 5, 'Hibernating'), (8, 1, 2, 1, 2, 1, 2, 'Lost'), (9, 1, 5, 1, 5, 1, 5, 'Others'))"""

VALUE_TIER_ROWS = f"""(VALUES ('Premium', 10000, {FAR}), ('High Value', 5000, 10000), ('Medium Value', 2000, 5000),
    ('Low Value', 500, 2000), ('New/Inactive', -{FAR}, 500)) AS tier_band(label, least, below)"""
ACTIVITY_ROWS = f"""(VALUES ('Active', -{FAR}, 30), ('At Risk', 30, 90), ('Inactive', 90, 180), ('Lost', 180, {FAR}))
    AS activity_band(label, above, upto)"""
GROWTH_ROWS = """(VALUES ('Champions', 10), ('Loyal Customers', 10), ('Potential Loyalists', 8), ('Promising', 8), ('Need Attention', 6),
    ('About to Sleep', 4), ('At Risk', 2)) AS growth(label, points)"""
RECENCY_LABEL_ROWS = f"""(VALUES ('Recent', -{FAR}, 30), ('Moderate', 30, 90), ('Distant', 90, 180), ('Very_Distant', 180, {FAR}))
    AS recency_label(label, above, upto)"""
FREQUENCY_LABEL_ROWS = f"""(VALUES ('High_Frequency', 20, {FAR}), ('Medium_Frequency', 10, 20), ('Low_Frequency', 5, 10),
    ('Very_Low_Frequency', -{FAR}, 5)) AS frequency_label(label, least, below)"""
VALUE_LABEL_ROWS = f"""(VALUES ('High_Value', 1000, {FAR}), ('Medium_Value', 500, 1000), ('Low_Value', 100, 500),
    ('Very_Low_Value', -{FAR}, 100)) AS value_label(label, least, below)"""
VOLATILITY_ROWS = f"""(VALUES ('Low Volatility', -{FAR}, 100), ('Medium Volatility', 100, 500)) AS volatility_band(label, least, below)"""

# Labels of the day's revenue and orders against the mean of seven days, and the day's score.
SCORE_ROWS = """(VALUES
    ('Above Average', 'Above Average', 10), ('Above Average', 'Average', 8), ('Above Average', 'Below Average', 8),
    ('Average', 'Above Average', 8), ('Below Average', 'Above Average', 8), ('Average', 'Average', 6),
    ('Average', 'Below Average', 4), ('Below Average', 'Average', 4), ('Below Average', 'Below Average', 4))
    AS day_score(revenue_label, orders_label, points)"""
# One label a month, January first.
MONTH_SEASONS = ("['Holiday Season', 'Fall', 'Spring', 'Spring', 'Spring', 'Summer', 'Summer', 'Summer', "
                 "'Fall', 'Fall', 'Holiday Season', 'Holiday Season']")


def segment_cells(rows: str, name: str) -> str:
    """A table of all 125 score triples and the first label that covers each."""
    return f"""
{name} AS (
    SELECT r, f, m, arg_min(label, rule_no) AS label
    FROM range(1, 6) AS a(r), range(1, 6) AS b(f), range(1, 6) AS c(m),
         {rows} AS covers(rule_no, r_least, r_most, f_least, f_most, m_least, m_most, label)
    WHERE r BETWEEN r_least AND r_most AND f BETWEEN f_least AND f_most AND m BETWEEN m_least AND m_most
    GROUP BY r, f, m
)"""
