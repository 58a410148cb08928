import collections
import random
import re

from pyspark.sql import functions as F

from heddle.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    m = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_letter_words": sum(any(c.isalpha() for c in w) for w in words), "n_capitals": sum(c.isupper() for c in text),
        "n_exclaims": text.count("!"), "n_cut_lines": sum(line.endswith(("...", "…")) for line in lines),
    }
    fails = [
        m["n_words"] < 10, 100 * m["n_repeat_words"] > 20 * m["n_words"], m["n_words"] > 100_000, not 3 * m["n_words"] <= m["word_chars"] <= 10 * m["n_words"],
        10 * m["n_symbols"] > m["n_words"], m["n_dup_lines"] > 3 and 10 * m["n_dup_lines"] > 3 * m["n_lines"], m["n_words"] >= 30 and 100 * m["n_letter_words"] < 80 * m["n_words"],
        2 * m["n_capitals"] > m["word_chars"], 2 * m["n_exclaims"] > m["n_words"], m["n_cut_lines"] > 3 and 10 * m["n_cut_lines"] > 3 * m["n_lines"],
    ]
    return m, sum(1 << i for i, f in enumerate(fails) if f)


def texts():
    chance = random.Random(5)
    made = [None, "", " \n\t ", "a", "a b c d", "a b c d e", "a b c d e a b c d e", "a " * 30, "x\n" * 9, "été " * 12, "HALLO!! WELT!! " * 9, "| a | b | c\x00 d\r\ne\x0bf…\n", "word joined by no-break " * 3]
    for n in (12, 60, 400, 3000):
        for vocabulary in (2, 3, 30):
            made.append("".join(chance.choice(["ab", "cde", "Füß", "#x", "9", "Ende...", "yes!"][:vocabulary] + [f"w{i}" for i in range(vocabulary)]) + chance.choice([" ", "  ", "\n", "\t", " \n\n"]) for _ in range(n)))
    return made


def test_ledger_against_plain_counts(spark):
    made = texts() + ["a b c d e " * 40_000]
    df = spark.createDataFrame([(i if i % 7 else None, t, "x") for i, t in enumerate(made)], "doc_id long, text string, kept string")
    found = q.ledger(df.withColumn("doc_id", F.monotonically_increasing_id()).coalesce(1)).orderBy("doc_id").collect()
    assert len(found) == len(made)
    for row, text in zip(found, made):
        m, failed = by_hand(text)
        assert {k: row[k] for k in q.MEASURES} == m, text and text[:80]
        assert row["failed"] == failed
    assert q.ledger(df).where("doc_id is null").count() == len(range(0, len(made), 7))


def test_windows_whose_half_hashes_meet_are_compared_as_texts(spark, monkeypatch):
    """A hash that tells nothing leaves the answer right."""
    monkeypatch.setattr(q.F, "xxhash64", lambda *columns: F.lit(0).cast("long"))
    made = texts()[:20]
    rows = spark.createDataFrame([(i, t or "") for i, t in enumerate(made)], "i int, text string").select("i", q.repeated_words(F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")).alias("n"))
    assert {r["i"]: r["n"] for r in rows.collect()} == {i: by_hand(t)[0]["n_repeat_words"] for i, t in enumerate(made)}


def test_policies_and_ablations(spark):
    rows = spark.createDataFrame([(0, 10), (0, 20), (q.BITS["symbols"], 5), (q.BITS["symbols"] | q.BITS["shouting"], 7), (q.BASE, 1)], "failed long, n_words long")
    kept = {p.version: q.apply_policy(rows, p).where("kept").count() for p in q.POLICIES}
    assert kept == {1: 4, 2: 3, 3: 2}
    told = {(r["version"], r["rule"]): r.asDict() for r in q.ablations(rows).collect()}
    assert told[3, "symbols"] == {"version": 3, "rule": "symbols", "docs": 5, "breaking": 2, "dropped": 3, "dropped_without": 2, "words_back": 5}
    assert told[2, "shouting"] == {"version": 2, "rule": "shouting", "docs": 5, "breaking": 1, "dropped": 2, "dropped_without": 1, "words_back": 7}
    # of two rules that drop the same document neither does so alone
    assert told[1, "few_words"]["dropped_without"] == told[1, "few_words"]["dropped"] == 1
    assert q.ablations(rows.limit(0)).count() == 0


def test_empty_tables_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert q.apply_policy(q.ledger(none)).count() == 0
    prose = " ".join(f"word{chr(97 + i)} text" for i in range(12))
    df = spark.createDataFrame([(1, prose, True, 1), (1, prose, True, 1), (2, "#", False, 2)], "doc_id long, text string, kept boolean, failed int")
    kept = q.keep_passing(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, prose, True, 1)] * 2


def test_no_python_and_one_scan(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string").write.parquet(path)
    plan = q.op11_quality_rules(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan) and plan.count("FileScan") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
