"""The registered corpus queries and the pipeline against plain Python over the small tables."""

import os
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from heddle.llm import mixing, packing, registry, secrets
from tests.llm.test_simhash import brute_components, slow_fingerprint
from tests.llm.test_simhash_sets import brute_kept
from tests.llm.test_tokens import check_packing
from tests.test_queries import SF_DIR, compare

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, tmp_path, name):
    compare(registry.queries()[name](spark, SF_DIR), registry.oracle_sql()[name], str(tmp_path / "rows"))


def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_simhash_query_against_brute_force(spark):
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in registry.queries()["op2_simhash"](spark, SF_DIR).collect()}
    prints = {k: slow_fingerprint(t) for k, t in documents(spark).items()}
    parts = brute_components(prints)
    assert found == {k: (f"{p:016x}", parts[k]) for k, p in prints.items()}


def test_quality_query_holds_out_a_third(spark):
    found = registry.queries()["op5_quality"](spark, SF_DIR).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert len(found) == len(documents(spark))


def test_mixing_query_counts_words_and_meets_its_targets(spark, tmp_path):
    """Tokens against SQL over whole documents; expected tokens by language against the targets."""
    rates = registry.queries()["op1_mixing"](spark, SF_DIR)
    compare(rates.select("doc_id", "tokens"), r"SELECT doc_id, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[ \n\t\r]'), lambda w: w <> '')) AS BIGINT) AS tokens FROM documents", str(tmp_path / "rows"))
    rows = rates.collect()
    total = sum(r["tokens"] for r in rows)
    for lang, share in mixing.TARGETS.items():
        assert abs(sum(r["rate"] * r["tokens"] * r[f"p_{lang}"] for r in rows) / total - share) < 0.01
    assert all(r["rate"] >= 0 and abs(sum(r[f"p_{lang}"] for lang in mixing.TARGETS) - 1) < 1e-9 for r in rows)


def test_packing_query_drops_ids_only(spark):
    found = registry.queries()["op3_packing"](spark, SF_DIR)
    whole = packing.pack(spark.read.parquet(f"{SF_DIR}/documents.parquet"), public_tokenizers.path(packing.VOCABULARY))
    assert found.columns == whole.drop("ids").columns
    assert sorted(map(tuple, found.coalesce(1).collect()), key=str) == sorted(map(tuple, whole.drop("ids").collect()), key=str)


def test_stages_with_odd_rows(spark):
    """Nulls, empty texts, repeated rows, an empty table and columns whose names the stages use themselves."""
    base = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    kinds = base.schema
    first = base.orderBy("doc_id").first().asDict()
    odd = [first | {"text": None}, first | {"doc_id": 900_001, "text": ""}, first | {"doc_id": 900_002, "text": None, "lang": None}, first | {"doc_id": None}, first]
    odd += [first | {"doc_id": 900_003, "text": "password: " + "x7" * 40_000}]
    more = base.unionByName(spark.createDataFrame([tuple(r[c] for c in base.columns) for r in odd], kinds))
    more = more.withColumns({"score": F.lit(1), "set_id": F.lit("a"), "_dropped": F.lit(True), "rate": F.lit(None).cast("int"), "sequence_id": F.lit(0)})
    for name, stage in corpus_pipeline.STAGES:
        found, none = stage(spark, more, SF_DIR), stage(spark, more.limit(0), SF_DIR)
        assert none.count() == 0 and found.count() > 0
        if name != "packing":
            assert found.columns == more.columns and found.schema == more.schema
        if name in ("secrets", "mixing"):
            assert {r[0] for r in found.select("doc_id").collect()} >= {900_001, 900_002, 900_003, None}
        if name == "secrets":
            assert found.where("doc_id = 900003").first()["text"] == "password: <SECRET>"
            assert found.where("text is null").count() == more.where("text is null").count()


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, texts = docs.columns, documents(spark)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixing", "packing"]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SF_DIR).write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
    good, single, clean, mixed, packed = kept[1:]
    assert all(k.columns == columns for k in kept[1:5])
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    wrong = [k for k, q in labels.items() if (k in ids(good)) != (q == 1)]
    assert len(wrong) <= 0.05 * len(labels)
    # the stage's criterion is a Jaccard similarity of five-word shingles of 0.8 or more
    assert sorted(ids(single)) == brute_kept(sorted((k, texts[k]) for k in ids(good)))
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in clean.collect():
        assert not any(k in (1, 2) for _, k, _ in secrets.base_spans(r["text"])) and r["n_chars"] == len(r["text"])
        assert r["text"] == before[r["doc_id"]] or secrets.base_spans(before[r["doc_id"]])
    times = Counter(r[0] for r in mixed.select("doc_id").collect())
    assert set(times) == ids(clean)
    words = Counter()
    for r in mixed.select("lang", F.size(F.split("text", r"\s+")).alias("n")).collect():
        words[r["lang"]] += r["n"]
    total = sum(words.values())
    assert all(abs(words[lang] / total - share) < 0.08 for lang, share in corpus_pipeline.TARGETS.items())
    assert packed.agg(F.sum("length")).first()[0] == packed.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert Counter(r[0] for r in packed.where("start = 0").select("doc_id").collect()) == times
    padding = check_packing(packing.pack(clean, public_tokenizers.path(packing.VOCABULARY)).collect(), [(r["doc_id"], r["text"]) for r in clean.limit(40).collect()])
    assert padding == 0


    # run() is these stages in a row
    pieces = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert pieces(corpus_pipeline.run(spark, SF_DIR).select("doc_id", "doc_tokens").where("start = 0")) == pieces(packed.select("doc_id", "doc_tokens").where("start = 0"))
