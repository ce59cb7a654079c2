"""run() against a plain re-computation of every stage on the driver, with odd rows added."""

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from ledgerlight.llm import bpe, decontaminate, langid, secrets
from ledgerlight.llm.common import id_remainder

from .test_secrets import brute as brute_secrets
from .test_simhash import brute_components, brute_fingerprint

SMALL = "/root/testdata/sf0.001"
ODD = [(100_000, None, "en", "src0", 0), (100_001, "", "en", None, 0), (100_002, "12 34 !!", None, "src1", 8), (100_003, "the and of that is", None, "src1", 17),
       (100_003, "the and of that is", None, "src1", 17), (None, "the thing with the other and that is here", "en", "src2", 41)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    more = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    docs.union(more.select([more[f.name].cast(f.dataType) for f in docs.schema])).withColumn("component_id", docs["lang"]).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    # 1. language
    model = langid.train(docs.where(id_remainder("doc_id", 5) != 0))
    joint = langid.log_likelihood(model.log_prob, model.log_prior, [r["text"] or "" for r in rows])
    rows = [r for r, s in zip(rows, langid._decide(joint)[1]) if s >= 0.5 and any(c.isalpha() for c in r["text"] or "")]
    # 2. one row of each component: that of the smallest id
    fps = [brute_fingerprint(r["text"]) for r in rows]
    found = brute_components(fps, [r["doc_id"] for r in rows])
    kept = {}
    for r, c in zip(rows, found):
        if r["doc_id"] == c:
            kept.setdefault(c if c is not None else ("no id", r["text"]), r)
    rows = list(kept.values())
    # 3. no benchmark item
    items = [decontaminate.normalised(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(decontaminate.best_match(i, decontaminate.normalised(r["text"]), decontaminate.budget(i, 0.0625)) for i in items)]
    # 4. secrets
    for r, (_, _, spans, _) in zip(rows, brute_secrets([(r["doc_id"], r["text"], r["source"]) for r in rows])):
        out, at = "", 0
        for start, _, end, *_ in spans:
            out += r["text"][at:start] + secrets.PLACEHOLDER if start >= at else ""
            at = max(at, end)
        r["text"] = out + r["text"][at:]
    # 5. ids
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted(((r["doc_id"], theirs.encode_ordinary(r["text"])) for r in rows), key=str)
    got = corpus_pipeline.run(spark, folder).collect()
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)
    assert sorted(((r["doc_id"], list(r["ids"])) for r in got), key=str) == want
    assert 100 < len(got) < docs.count() - 10


def test_all_but_the_last_stage_return_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder).columns == docs.columns


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secret_scan", "encoding"]
