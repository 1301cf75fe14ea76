from __future__ import annotations

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from handbill.llm import fingerprints as fp

TEXT = st.text(alphabet="abé😀\n", max_size=60)


@settings(max_examples=80, deadline=None)
@given(TEXT, TEXT, st.integers(0, 60), st.integers(0, 60))
def test_spans_and_extensions(a, b, i, j):
    i, j = min(i, len(a)), min(j, len(b))
    x, y = fp.Prefix(fp.code_points(a)), fp.Prefix(fp.code_points(b))
    want = next((k for k, (p, q) in enumerate(zip(a[i:], b[j:], strict=False)) if p != q), min(len(a) - i, len(b) - j))
    assert x.extension(i, y, j) == want
    for n in range(min(len(a) - i, len(b) - j) + 1):
        assert x.equal(i, y, j, n) == (a[i : i + n] == b[j : j + n])


@settings(max_examples=50, deadline=None)
@given(TEXT, TEXT)
def test_kept_prefix_gives_the_same_arrays(a, b):
    cut = len(a) // 2
    whole = fp.Prefix(fp.code_points(a[:cut] + b))
    kept = fp.Prefix(fp.code_points(a[:cut] + b), (fp.Prefix(fp.code_points(a)), cut))
    assert fp.fingerprint(whole)[0] == fp.fingerprint(kept)[0]
    assert (fp.sketch_of(fp.fingerprint(whole)[0]) == fp.fingerprint(whole)[1] >> 24).all()


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest() if r[1] is not None else ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t)
        e = t[: n - n // 4] + after[: n // 4]
        lcp = next((x for x, (p, q) in enumerate(zip(t, e, strict=False)) if p != q), min(len(t), len(e)))
        out.append((i, n, hashlib.sha256(e.encode()).hexdigest(), lcp))
    return sorted(out, key=repr)


def test_query_matches_brute_force(docs_of):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abcdé😀 ") for _ in range(rng.randrange(400)))) for i in range(0, 120, 3)]
    rows += [(7, None), (8, ""), (10, "same text " * 40), (11, "same text " * 40), (11, "same text " * 40), (11, "another"), (None, "no id"), (-5, "x" * 50000)]
    got = fp.fingerprints(docs_of(*rows, extra="range")).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.common_prefix) for r in got), key=repr) == brute(rows)
    assert len({r.fingerprint for r in got if r.doc_id in (10,)} | {r.fingerprint for r in got if r.doc_id == 11}) == 2
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert next(r for r in got if r.doc_id == 10).near_next == 1.0


def test_likeness_follows_the_share_kept(docs_of):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(3000))) for i in range(20)]
    got = fp.fingerprints(docs_of(*rows)).collect()
    assert all(abs(r.near_edited - 0.75) < 0.2 and r.near_next < 0.1 for r in got)


def test_single_and_empty(docs_of):
    r = fp.fingerprints(docs_of((1, "abcdefgh"))).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert fp.fingerprints(docs_of((1, "a")).limit(0)).count() == 0


def test_likeness_of_short_texts_is_exact(docs_of):
    """With fewer spans than a sketch holds, against sets of spans and the common ends."""

    def spans(t):
        return {t[i : i + fp.SPAN] for i in range(max(1, len(t) - fp.SPAN + 1))} if t else set()

    def want(a, b):
        if not a or not b:
            return float(a == b)
        lcp = next((k for k, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))
        lcs = next((k for k, (p, q) in enumerate(zip(a[::-1], b[::-1], strict=False)) if p != q), min(len(a), len(b)))
        j = len(spans(a) & spans(b)) / len(spans(a) | spans(b))
        return max(2 * j / (1 + j), min(len(a), len(b), lcp + lcs) / max(len(a), len(b)))

    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("abcd é") for _ in range(rng.choice([0, 1, 3, 10, 40, 60])))) for i in range(60)]
    rows += [(100 + i, "one text of its own, "[: 5 + i]) for i in range(12)]
    got = {r.doc_id: r for r in fp.fingerprints(docs_of(*rows)).collect()}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(t)
        assert abs(got[i].near_edited - want(t, t[: n - n // 4] + after[: n // 4])) < 1e-9 and abs(got[i].near_next - want(t, after)) < 1e-9
    assert all(got[i].near_edited >= 0.5 for i, t in rows if len(t) >= 4)


def test_empty_table(docs_of):
    assert fp.fingerprints(docs_of((1, "a")).limit(0)).count() == 0
