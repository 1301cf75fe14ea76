from __future__ import annotations

import random

import pytest

from handbill.llm import lines


def brute(rows, min_lines, min_words):
    """The definition: a line goes if one of the shortest sufficient windows over it has the content of an earlier one."""
    docs = sorted({(i, t) for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for i, t in docs:
        if t is None:
            out[i, t] = None
            continue
        ls, gone = t.split("\n"), set()
        for p in range(len(ls)):
            words = 0
            for m in range(1, min_lines + 1):
                if p + m > len(ls):
                    break
                words += len(ls[p + m - 1].split())
                if words >= min_words or m == min_lines:
                    key = tuple(ls[p : p + m])
                    if key in seen:
                        gone |= set(range(p, p + m))
                    seen.add(key)
                    break
        out[i, t] = "\n".join(x for p, x in enumerate(ls) if p not in gone)
    return sorted((i, out[i, t]) for i, t in rows if i is not None)


@pytest.mark.parametrize("seed", range(3))
def test_matches_the_definition(docs_of, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abc") for _ in range(rng.choice([1, 2, 30, 60]))) for _ in range(12)] + [""]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, rows[0][1]), (102, rows[0][1]), (103, "\n".join(["same"] * 500)), (104, "x " * 20000)]
    got = lines.without_repeated_runs(docs_of(*rows, extra="pos"))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "pos"]
    assert sorted((r.doc_id, r.text) for r in got.collect()) == brute(rows, lines.MIN_LINES, lines.MIN_WORDS)


def test_runs_and_clean_text(docs_of):
    passage = " ".join(f"word{k}" for k in range(55))
    rows = [(1, f"one\n{passage}\ntwo"), (2, f"three\n{passage}\nfour"), (3, "short line\nof its own"), (4, "short line\nand another")]
    got = {r.doc_id: r for r in lines.without_repeated_runs(docs_of(*rows), added=True).collect()}
    assert got[1].text == rows[0][1] and got[2].text == "three\nfour" and [tuple(x) for x in got[2].deleted_runs] == [(1, 2)]
    assert got[3].text == rows[2][1] and got[4].text == rows[3][1] and got[2].n_chars == 10
    assert lines.without_repeated_runs(docs_of((1, "a")).limit(0)).count() == 0
    assert lines.without_repeated_runs(docs_of((None, f"{passage}"), (None, f"{passage}\nx"))).count() == 2


def test_native_plan(docs_of):
    plan = lines.without_repeated_runs(docs_of((1, "a\nb"), (2, "a\nb")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_passages(rows):
    """The definition: a word goes if it is in a window of PASSAGE words that occurs at an earlier place."""
    n, seen, out = lines.PASSAGE, set(), {}
    for i, t in sorted(rows):
        ws, gone = t.split(), set()
        for p in range(len(ws) - n + 1):
            key = tuple(ws[p : p + n])
            if key in seen:
                gone |= set(range(p, p + n))
            seen.add(key)
        out[i] = [w for p, w in enumerate(ws) if p not in gone]
    return out


@pytest.mark.parametrize("seed", range(2))
def test_passages_match_the_definition(docs_of, seed):
    rng = random.Random(seed)
    pool = [[f"p{k}w{rng.randrange(40)}" for _ in range(rng.choice([49, 50, 51, 80, 130]))] for k in range(8)]
    rows = []
    for i in range(40):
        ws = []
        for _ in range(rng.randrange(1, 5)):
            ws += [f"d{i}x{rng.randrange(9)}" for _ in range(rng.randrange(6))]
            p = rng.choice(pool)
            ws += p[rng.choice([0, 0, 5]) :]
        rows.append((i, "".join(w + rng.choice([" ", " ", "\n", "  "]) for w in ws)))
    rows += [(100, "a " * 300), (101, "short"), (102, "")]
    got = lines.without_repeated_passages(docs_of(*rows, extra="pos"))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "pos"]
    assert {r.doc_id: r.text.split() for r in got.collect()} == brute_passages(rows)


def test_passages_inside_lines(docs_of):
    passage = " ".join(f"word{k}" for k in range(55))
    rows = [(1, f"glued to {passage} more\nend"), (2, f"in a longer {passage} line\nlast"), (3, f"first\n{passage} rest"), (4, f"{passage}\nend\n"), (5, f"a  b\n{passage}"), (6, None), (7, "x \n")]
    got = {r.doc_id: r for r in lines.without_repeated_passages(docs_of(*rows)).collect()}
    assert [got[i].text for i in range(1, 8)] == [rows[0][1], "in a longer line\nlast", "first\nrest", "end\n", "a  b", None, "x \n"] and got[3].n_chars == 10


def test_passages_go_in_the_pipeline(spark, docs_of):
    import corpus_pipeline as p

    passage = " ".join(f"word{k}" for k in range(55))
    got = {r.doc_id: r.text for r in p.line_dedup(spark, docs_of((1, f"glued to {passage} more"), (2, f"in a longer {passage} line")), "").collect()}
    assert got == {1: f"glued to {passage} more", 2: "in a longer line"}
    plan = lines.without_repeated_passages(docs_of((1, "a\nb"), (2, "a\nb")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_generated_code_is_compiled(spark, docs_of):
    """The JVM leaves methods of over 8000 bytes uncompiled, and lambdas are interpreted: explode, comparison and hashing are in short generated methods."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    words = " ".join(f"w{k}" for k in range(120))
    docs = docs_of((1, words), (2, f"x\ty {words}  z"), (3, None), (4, " "))
    pairs = spark.createDataFrame([(2, 2, 1, 1, [(2, 0), (12, 10)])], "id long, hash long, of_id long, of_hash long, at array<struct<pos:int,of_pos:int>>")
    texts = spark.createDataFrame([(1, 1, list(range(70))), (2, 2, [-1, -2, *range(60), -3])], "id long, hash long, x array<long>")
    compared = lines._compared(pairs, texts)
    assert sorted((r.pos, r.l, r.r, r.r1 is None, r.l1 is None) for r in compared.collect()) == [(2, 0, 31, True, False), (12, 10, 31, True, False)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (lines.fingerprints(docs), lines.windows(docs), lines._compared(pairs, texts)):
            plan = df._jdf.queryExecution().executedPlan()
            sizes = [c._3().maxMethodCodeSize() for c in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(debug.codegenStringSeq(plan))]
            assert sizes and max(sizes) < 8000
        assert "Generate posexplode" in lines.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_words_of_odd_white_space(docs_of):
    texts = ["a  b\n\nc ", " a b", "a\tb \x0bc\r\nd", " a éb", "a b\n", "one"]
    docs = docs_of(*enumerate(texts))
    got = {r.doc_id: (r.words, r.n) for r in lines._split(docs).select("doc_id", "words", lines._count(lines.F.col("text")).alias("n")).collect()}
    want = [[w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", t)] for t in texts]
    assert [got[i][0] for i in range(len(texts))] == want
    single = {i for i, t in enumerate(texts) if "\n" not in t}  # _count takes a line
    assert all(got[i][1] == len(want[i]) for i in single)


def test_texts_are_cut_once_and_not_sorted(docs_of):
    """A filter that repeats the array of lines cuts and hashes every text twice; a merge join sorts whole texts."""
    docs = docs_of((1, "a\nb"), (2, "a\nb"), (3, None), (4, ""))
    windows = lines.windows(docs, 1, 50)
    assert windows._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert sorted((r.doc_id, r.pos, r.m) for r in windows.collect()) == [(1, 0, 1), (1, 1, 1), (2, 0, 1), (2, 1, 1), (4, 0, 1)]
    for df in (lines.without_repeated_runs(docs), lines.without_repeated_passages(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
