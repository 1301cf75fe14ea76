"""Line deduplication by winnowing, in DataFrame operations only: runs of lines first, then passages that are no whole lines.

Lines. Every start of a run has a window: the fewest next lines that hold ``min_words`` words, at most ``min_lines`` lines.
So each run of that many lines or words contains a window, the same in all its copies. The least line hash of a window is its fingerprint,
chosen by content alone and shared by overlapping windows. Fingerprints at one position only rule their windows out (min and max
position, pre-aggregated). The remaining windows are joined by the hash of all their lines (128 bits) with the first position of that
content; a window at a later position matches. Neighbouring matches make maximal runs, which are deleted.

Passages. The least word of a window of ``WINDOW`` words is the place of a fingerprint, the ``GRAM`` words from there on; overlapping windows
share it, so there is about one fingerprint in twelve words, and every passage of ``PASSAGE`` words holds one. Fingerprints are joined by
their hash with their first position, and the two texts are compared word by word both ways. What goes on beyond the match with the first
position is decided by content, see :func:`repeated_passages`; so a word is deleted if, and only if, it is in a passage that occurs at an earlier place.

The first occurrence is at no later place, so every text survives somewhere. No pairs of copies are made: each place meets only the first one,
and hot keys are split by the adaptive joins, whose sides are tables.

"Later" is by (doc_id, hash of the text, position); a null doc_id comes first. Defined cases: a null text has no lines
and stays null; an empty text stays empty; rows that repeat doc_id and text are one document and change alike; a text that loses
all lines becomes empty; texts of any length are read whole; an empty table gives an empty one. Other columns, whatever their names, are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, discard, stored

MIN_LINES, MIN_WORDS = 3, 50
#: Words of a passage, of a window whose least word is a fingerprint's place, and of a fingerprint; WINDOW is a power of 2. A passage holds a
#: window and the fingerprint at its place: WINDOW + GRAM - 1 = PASSAGE.
PASSAGE, WINDOW, GRAM = 50, 32, 19
#: White space within lines, beside spaces.
OTHER_WHITE = ("\t", "\x0b", "\x0c", "\r")


def _lines(text: str = "text") -> Column:
    return F.split(text, "\n")


def _holds(text: Column | str, *parts: str) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(p)) for p in parts))


def _count(line: Column) -> Column:
    """The number of WORDs of a line; where single spaces part them, by plain searches, which are several times faster."""
    spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    odd = (line == "") | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" ")) | _holds(line, "  ", *OTHER_WHITE)
    return F.when(odd, F.regexp_count(line, F.lit(WORD))).otherwise(spaces + 1)


def windows(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, pos, m, mark, w1, w2): each window with its number of lines, fingerprint and content hashes."""
    hashed = F.transform(_lines(), lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(7), x).alias("h2"), _count(x).alias("w")))
    rows = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), hashed.alias("lines"))
    shifted = [F.slice("lines", i + 1, F.greatest(F.size("lines") - i, F.lit(0))).alias(f"l{i}") for i in range(min_lines)]
    # outer: the filter that an inner one infers would compute the array of lines twice
    rows = rows.select("doc_id", "text_hash", F.posexplode_outer(F.arrays_zip(*shifted)).alias("pos", "at"))
    line = [F.col(f"at.l{i}") for i in range(min_lines)]
    m, total = F.lit(None).cast("int"), F.lit(0)
    sums = []
    for x in line:
        total = total + x["w"]
        sums.append(total)
    for i in reversed(range(min_lines)):
        whole = line[i].isNotNull()
        m = F.when(whole & ((sums[i] >= min_words) if i < min_lines - 1 else F.lit(True)), F.lit(i + 1)).otherwise(m)
    rows = rows.withColumn("m", m).where("m is not null")

    def over(f) -> Column:
        out = f(line)
        for i in reversed(range(1, min_lines)):
            out = F.when(F.col("m") == i, f(line[:i])).otherwise(out)
        return out

    least = over(lambda x: F.least(*(y["h1"] for y in x)) if len(x) > 1 else x[0]["h1"])
    rows, least = rows.withColumn("mark", least), F.col("mark")
    return rows.select("doc_id", "text_hash", "pos", "m", "mark", over(lambda x: F.xxhash64(*(y["h1"] for y in x))).alias("w1"), over(lambda x: F.xxhash64(F.lit(7), *(y["h2"] for y in x))).alias("w2"), over(lambda x: F.greatest(*(F.when(y["h1"] == least, F.lit(i)) for i, y in enumerate(x)), F.lit(-1))).alias("mark_at"))


def _merged(spans: DataFrame, key: list[str], name: str) -> DataFrame:
    """The spans [pos, to) of each document as maximal runs [start, end)."""
    by = Window.partitionBy(*key).orderBy("pos", "to")
    reach = F.max("to").over(by.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(F.col("pos") <= reach, 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, 0))
    return stored(spans.withColumn("run", run).groupBy(*key, "run").agg(F.min("pos").alias("start"), F.max("to").alias("end")).drop("run"), name)


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, start, end): the maximal runs of lines [start, end) that repeat earlier text."""
    every = stored(windows(docs, min_lines, min_words), "lines-windows")
    place = F.struct("doc_id", "text_hash", (F.col("pos") + F.col("mark_at")).alias("pos"))
    marks = every.groupBy("mark").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high").select("mark")
    marks = stored(marks, "lines-shared")  # a table: so the planner can split the joins at a hot line
    some = stored(every.join(marks.hint("merge"), "mark", "left_semi"), "lines-marked")
    discard(every)
    here = F.struct("doc_id", "text_hash", "pos")
    first = stored(some.groupBy("w1", "w2", "m").agg(F.min(here).alias("first"), F.max(here).alias("last")).where("first <> last").drop("last"), "lines-first")
    later = some.join(first.hint("merge"), ["w1", "w2", "m"]).where(here > F.col("first")).select("doc_id", "text_hash", "pos", (F.col("pos") + F.col("m")).alias("to")).distinct()
    runs = _merged(later, ["doc_id", "text_hash"], "lines-runs")
    discard(marks, some, first)
    return runs


def without_repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, added: bool = False) -> DataFrame:
    """The documents without the later copies of repeated runs. ``added``: also n_lines, n_deleted and deleted_runs, in place of columns of these names."""
    runs = repeated_runs(docs, min_lines, min_words)
    runs = runs.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__runs")).select(F.col("doc_id").alias("__line_id"), F.col("text_hash").alias("__line_hash"), "__runs")
    rows = docs.withColumn("__hash", F.xxhash64("text"))
    # the runs are hashed at any size, so that whole texts are not sorted; a plan that turns at a threshold would be another one at scale
    rows = rows.join(runs.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__line_id")) & (F.col("__hash") == F.col("__line_hash")), "left")
    lines = _lines()
    starts = F.concat(F.array(F.lit(0)), F.transform("__runs", lambda r: r["end"]))
    ends = F.concat(F.transform("__runs", lambda r: r["start"]), F.array(F.size(lines)))
    # the lines are cut once for each kept stretch, so a document's cost is its lines times its deleted runs
    text = F.expr("array_join(flatten(transform(arrays_zip(__starts, __ends), x -> slice(__lines, x.__starts + 1, x.__ends - x.__starts))), '\n')")
    kept = F.when(F.col("__runs").isNull(), F.col("text")).otherwise(text)
    rows = rows.withColumns({"__starts": starts, "__ends": ends, "__lines": F.when(F.col("__runs").isNotNull(), lines)})
    out = [kept.alias(c) if c == "text" else F.length(kept).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns if not (added and c in ("n_lines", "n_deleted", "deleted_runs"))]
    if added:
        deleted = F.aggregate(F.coalesce("__runs", F.array().cast("array<struct<start:int,end:int>>")), F.lit(0), lambda a, r: a + r["end"] - r["start"])
        out += [F.coalesce(F.size(F.when(F.col("text").isNotNull(), _lines())), F.lit(0)).alias("n_lines"), deleted.alias("n_deleted"), F.col("__runs").alias("deleted_runs")]
    return rows.select(*out)


def _id(c: str = "doc_id") -> Column:
    """The key of a document: a null id counts as the smallest, so that joins are plain ones."""
    return F.coalesce(F.col(c).cast("long"), F.lit(-(2**63)).cast("long"))


def _split(rows: DataFrame) -> DataFrame:
    """The rows with the array ``words`` of their text; a text without other white space than spaces and line breaks is cut by a plain search."""
    by_pattern = F.split(F.btrim("text", F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")
    plain = F.array_remove(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " "), "")
    return rows.withColumn("words", F.when(_holds("text", *OTHER_WHITE), by_pattern).otherwise(plain))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(id, hash, pos, g1, g2): the places of the least words of all windows of WINDOW words that start a passage, and the hashes of the GRAM words from
    there on. The order of words is by hash, the first of equals is less.

    A window's least word is a new place where the word before the window was the least one of those up to the window's last word, or the last word is.
    Arrays of hashes are exploded rather than transformed: explode, slice and array_min are compiled, lambdas are not."""
    # by characters, as a filter on the number of words would cut the words twice
    rows = _split(docs.where(F.length("text") >= 2 * PASSAGE - 1).select(_id().alias("id"), F.xxhash64("text").alias("hash"), "text"))
    rows = rows.select("id", "hash", F.transform("words", lambda w: F.xxhash64(w)).alias("x"))
    # outer: the filter that an inner one infers would compute the array twice
    rows = rows.select("id", "hash", "x", F.posexplode_outer("x").alias("i", "v")).where(F.col("i") <= F.size("x") - PASSAGE)
    i = F.col("i")
    inner = F.slice("x", i + 1, F.lit(WINDOW - 1))
    before, last, least = F.get("x", i - 1), F.get("x", i + (WINDOW - 1)), F.array_min(inner)
    # most windows fail by a few of their words, without a slice
    few = F.least("v", *(F.get("x", i + n * WINDOW // 4 - 2) for n in (1, 2, 3, 4)))
    rows = rows.where((i == 0) | (few >= F.least(before, last))).where((i == 0) | (least >= F.least(before, last)))
    # a last word that only equals the least one before it is no new place
    rows = rows.where((i == 0) | (before <= last) | (least > last))
    rows = rows.select("id", "hash", "x", "i", last.alias("last"), inner.alias("inner")).withColumn("least", F.array_min("inner"))
    last, least = F.col("last"), F.col("least")
    rows = rows.select("id", "hash", "x", F.when(last < least, i + (WINDOW - 1)).otherwise(i - 1 + F.array_position("inner", least).cast("int")).alias("pos"))
    return rows.select("id", "hash", "pos", F.slice("x", F.col("pos") + 1, F.lit(GRAM)).alias("gram")).select("id", "hash", "pos", *_hashed(F.col("gram")))


def _hashed(words: Column) -> list[Column]:
    return [F.xxhash64(words).alias("g1"), F.xxhash64(F.lit(7), words).alias("g2")]


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(id, hash, start, end): the maximal runs of words [start, end) that lie in passages of PASSAGE words which occur at an earlier place.

    The places of a fingerprint meet its first place, and both texts are compared word by word to either side. Where a text goes on in another way
    than that of the first place, its passages that go so far can occur only in texts that go on in the same way: the fingerprint with the words up to
    there is longer, and where places share the longer one, the passages around it meet by their content."""
    pairs, *made = _with_first(stored(fingerprints(docs), "passages-marks"))
    pairs = stored(pairs.groupBy("id", "hash", "of_id", "of_hash").agg(F.collect_set("at").alias("at")), "passages-pairs")
    discard(*made)
    met = pairs.select("id", "hash").unionByName(pairs.select(F.col("of_id").alias("id"), F.col("of_hash").alias("hash"))).distinct()
    texts = docs.select(_id().alias("id"), F.xxhash64("text").alias("hash"), "text").join(met.hint("shuffle_hash"), ["id", "hash"], "left_semi")
    texts = _split(texts.groupBy("id", "hash").agg(F.first("text").alias("text"))).select("id", "hash", F.transform("words", lambda w: F.xxhash64(w)).alias("x"))
    texts = stored(texts, "passages-texts")
    compared = stored(_compared(pairs, texts), "passages-spans")
    discard(pairs)
    # the passages around the longer fingerprints that places share
    key = ["g1", "g2", "left", "right"]
    open_ = [F.struct(F.col(f"{side}1").alias("g1"), F.col(f"{side}2").alias("g2"), left.alias("left"), right.alias("right")) for side, left, right in (("r", F.lit(0), F.col("r") + 1), ("l", F.col("l") + 1, F.lit(0)))]
    longer = compared.select("id", "hash", "pos", F.inline(F.array(*open_))).where("g1 is not null")
    longer, shared = _shared(longer, key)
    starts = longer.select("id", "hash", F.greatest(F.lit(0), F.col("pos") + GRAM + F.col("right") - PASSAGE).alias("pos"), (F.col("pos") - F.col("left") + 1).alias("to"))
    starts = _merged(starts, ["id", "hash"], "passages-starts")
    last = F.least(F.col("end") - 1, F.size("x") - PASSAGE)
    bodies = starts.join(texts.hint("merge"), ["id", "hash"]).select("id", "hash", "x", F.explode_outer(F.when(F.col("start") <= last, F.sequence("start", last))).alias("pos")).where("pos is not null")
    bodies = bodies.select("id", "hash", "pos", F.slice("x", F.col("pos") + 1, F.lit(PASSAGE)).alias("body"))
    bodies = stored(bodies.select("id", "hash", "pos", *_hashed(F.col("body"))), "passages-bodies")
    discard(texts, shared, starts)
    again, *made = _with_first(bodies)
    again = again.select("id", "hash", "at.pos", (F.col("at.pos") + PASSAGE).alias("to"))
    spans = compared.where(F.col("l") + GRAM + F.col("r") >= PASSAGE).select("id", "hash", (F.col("pos") - F.col("l")).alias("pos"), (F.col("pos") + GRAM + F.col("r")).alias("to"))
    runs = _merged(spans.unionByName(again), ["id", "hash"], "passages-runs")
    discard(compared, *made)
    return runs


def _shared(rows: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``key`` other rows share, and the table of these keys. Counts, as they are aggregated by hashing, and few keys are shared; each
    is in the table once, and the rows of a hot one are split by the planner."""
    keys = stored(rows.groupBy(*key).count().where("count > 1").select(*key), "passages-shared")
    return rows.join(keys.hint("shuffle_hash"), key, "left_semi"), keys


def _with_first(every: DataFrame) -> tuple[DataFrame, ...]:
    """(id, hash, of_id, of_hash, at): the rows of the table ``every`` whose content occurs at an earlier place, with the first one. Then the tables it reads; ``every`` is deleted."""
    key, place = ["g1", "g2"], F.struct("id", "hash", "pos")
    some, keys = _shared(every, key)
    some = stored(some, "passages-some")
    discard(every, keys)
    first = stored(some.groupBy(*key).agg(F.min(place).alias("first")), "passages-first")  # a table: so the planner can split the join at a hot key
    later = some.join(first.hint("merge"), key).where(place > F.col("first"))
    return later.select("id", "hash", F.col("first.id").alias("of_id"), F.col("first.hash").alias("of_hash"), F.struct("pos", F.col("first.pos").alias("of_pos")).alias("at")), some, first


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, hash, pos, l, r, r1, r2, l1, l2) of each fingerprint of a pair of texts: how many words before and after it are equal, and the hashes of the
    fingerprint with the next word to the right or left, where passages go on beyond the equal words; else null.

    The words are compared by halves: as many as a power of 2, then the next lower one from there on."""
    both = pairs.join(texts.hint("merge"), ["id", "hash"]).join(texts.select(F.col("id").alias("of_id"), F.col("hash").alias("of_hash"), F.col("x").alias("y")).hint("merge"), ["of_id", "of_hash"])
    reach = WINDOW - 1  # so far a passage can go on before its fingerprint, and after it
    rows = both.select("id", "hash", "x", "y", F.inline_outer("at")).where("pos is not null")
    # the words in reach: u of the text, v of the other one, with the fingerprint at place p of u and q of v
    rows = rows.withColumns({"p": F.least("pos", F.lit(reach)), "q": F.least("of_pos", F.lit(reach))})
    u, v = (F.slice(x, F.col(pos) - F.col(p) + 1, F.col(p) + GRAM + reach) for x, pos, p in (("x", "pos", "p"), ("y", "of_pos", "q")))
    rows = rows.select("id", "hash", "pos", "p", "q", u.alias("u"), v.alias("v"), F.lit(0).alias("l"), F.lit(0).alias("r"))
    p, q, l, r = (F.col(c) for c in ("p", "q", "l", "r"))
    halves = [WINDOW >> n for n in range(1, WINDOW.bit_length())]
    for k in halves:
        equal = F.slice("u", p + GRAM + r + 1, F.lit(k)) == F.slice("v", q + GRAM + r + 1, F.lit(k))
        rows = rows.withColumn("r", r + F.when(equal, F.lit(k)).otherwise(F.lit(0)))
    # both slices end where both texts do. A lambda isn't compiled, so it parts the generated code: the JVM compiles no method of over 8000 bytes
    after = F.least(F.size("u") - p - GRAM, F.size("v") - q - GRAM)
    rows = rows.withColumn("r", F.get(F.transform(F.array("r"), lambda n: F.least(n, after)), F.lit(0)))
    for k in halves:
        equal = F.slice("u", F.greatest(p - l - k + 1, F.lit(1)), F.lit(k)) == F.slice("v", F.greatest(q - l - k + 1, F.lit(1)), F.lit(k))
        rows = rows.withColumn("l", l + F.when((l + k <= F.least(p, q)) & equal, F.lit(k)).otherwise(F.lit(0)))
    on_right, on_left = (r < reach) & (p + GRAM + r < F.size("u")), (l < reach) & (p > l)
    longer = F.when(on_right, F.slice("u", p + 1, GRAM + r + 1)).alias("to_right"), F.when(on_left, F.slice("u", F.greatest(p - l, F.lit(1)), GRAM + l + 1)).alias("to_left")
    rows = rows.select("id", "hash", "pos", "l", "r", *longer)  # cut once for both hashes
    return rows.select("id", "hash", "pos", "l", "r", *(F.when(F.col(c).isNotNull(), h).alias(f"{c[3]}{n}") for c in ("to_right", "to_left") for n, h in enumerate(_hashed(F.col(c)), 1)))


def without_repeated_passages(docs: DataFrame, added: bool = False) -> DataFrame:
    """The documents without the later copies of passages of PASSAGE words, wherever in a line they stand. A deleted run takes the white space
    before it along; where only that has a line break, it stays in place of the white space after the run. ``added``: also words_deleted, in place of a column of that name."""
    runs = repeated_passages(docs)
    runs = runs.groupBy("id", "hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__runs")).select(F.col("id").alias("__line_id"), F.col("hash").alias("__line_hash"), "__runs")
    rows = docs.withColumns({"__id": _id(), "__hash": F.xxhash64("text")})
    rows = rows.join(runs.hint("shuffle_hash"), (F.col("__id") == F.col("__line_id")) & (F.col("__hash") == F.col("__line_hash")), "left")
    white = r"[\x20\x09-\x0D]"
    rows = rows.withColumn("__words", F.when(F.col("__runs").isNotNull(), F.regexp_extract_all("text", F.lit(f"{white}*{WORD}"), F.lit(0))))
    before = lambda at: F.regexp_extract(F.get("__words", at), f"^{white}*", 0)

    def stretch(r: Column, to: Column) -> Column:
        """The words from a run's end to the next run, with the white space that stays before them."""
        said = F.array_join(F.slice("__words", r["end"] + 1, to - r["end"]), "")
        gap = before(r["start"])
        return F.when(r["start"] == 0, F.regexp_replace(said, f"^{white}+", "")).when(F.contains(gap, F.lit("\n")) & ~F.contains(before(r["end"]), F.lit("\n")), F.concat(gap, F.regexp_replace(said, f"^{white}+", ""))).otherwise(said)

    head = F.array_join(F.slice("__words", F.lit(1), F.get("__runs", F.lit(0))["start"]), "")
    tails = F.transform("__runs", lambda r, i: stretch(r, F.coalesce(F.get("__runs", i + 1)["start"], F.size("__words"))))
    kept = F.when(F.col("__runs").isNull(), F.col("text")).otherwise(F.concat(head, F.array_join(tails, ""), F.regexp_extract("text", f"{white}*$", 0)))
    out = [kept.alias(c) if c == "text" else F.length(kept).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns if not (added and c == "words_deleted")]
    if added:
        out.append(F.aggregate(F.coalesce("__runs", F.array().cast("array<struct<start:int,end:int>>")), F.lit(0), lambda a, r: a + r["end"] - r["start"]).alias("words_deleted"))
    return rows.select(*out)


def deduplicated(docs: DataFrame, added: bool = False) -> DataFrame:
    """The documents without the later copies of runs of lines, and then without those of passages that are no whole lines."""
    return without_repeated_passages(stored(without_repeated_runs(docs, added=added), "lines-once"), added)
