"""Line rules, winnowing and near-duplicates against plain Python."""

import random
import re
from collections import Counter

import pytest
import xxhash

from tests.llm.frames import SCHEMA, clashing, odd, odd_rows, prose
from tidewatch.llm import line_rules, pivots, winnowing

BLANK = r"[^\x20\x09-\x0D]+"


def base(text):
    text = text or ""
    w = re.findall(BLANK, text)
    lines = [x for x in text.split("\n") if re.search(BLANK, x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_line_rules_count_as_brute_force(spark):
    rng = random.Random(1)
    rows = odd_rows()[:5] + [(100 + i, "\n".join(prose(rng, rng.randrange(0, 40), "a b c # d|e x".split() + [f"w{j}" for j in range(60)]) for _ in range(4)), None, None, None) for i in range(40)]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "n_words", "kept", "n_lines")
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in line_rules.measured(df).collect())
    assert got == Counter((r[0], *base(r[1])) for r in rows)


@pytest.mark.parametrize("line, fault", [
    ("Licensed under the MIT License.", "boilerplate"), ("We use COOKIES here to see you.", None), ("We use cookies here to see you.", "boilerplate"),
    ("Home", "navigation"), ("a | b | c | d", "navigation"), ("One two", "navigation"), ("One two.", None), ("Read more", "navigation"),
    ("NOW!! BUY!! IT!! all.", "punctuation"), ("w### x*** y$$$ z%%% end.", "punctuation"), ("A plain line of words, no end", None), ("", None),
])
def test_line_faults(spark, line, fault):
    df = spark.createDataFrame([(1, line)], "doc_id long, text string")
    got = {k for k, v in line_rules.measured(df).first()["line_faults"].items() if v}
    assert got == ({fault} if fault and fault != "none" else set()) or line.startswith("We use COOKIES") and got == {"boilerplate"}


def test_cleaned_drops_lines_and_keeps_columns(spark):
    good = ". ".join(f"Word{i} stands for number{i}" for i in range(40)) + "."
    rows = [(1, good + "\nAll rights reserved.", "en", "a", 5), (2, "BUY!! NOW!! " * 60, "en", "a", 5), (3, None, None, None, None), (1, good + "\nAll rights reserved.", "en", "a", 5)]
    got = line_rules.cleaned(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(1, good, "en", "a", len(good))] * 2
    assert line_rules.cleaned(spark.createDataFrame([], SCHEMA)).count() == 0
    assert line_rules.cleaned(odd(spark)).columns == odd(spark).columns


def test_long_lines_survive_single_marks(spark):
    marks = [
        ("our privacy policy and the terms of use", True), ("il dit «oui», puis «non», enfin «peut-être»", True), ("er sagt »ja«, dann »nein«, dann »doch«", True),
        ("col·lecció il·lustra intel·ligent", True), ("| a | b | c", True), ("| " * 60, False),
    ]
    short = ["See our privacy policy for all that we do with what you send.", "Home » News » Sports » Weather", "Un · dos · tres · quatre i cinc", "« a » b » c » d » e"]
    long = [" ".join(f"word{i}" for i in range(30)) + f", {m}, " + " ".join(f"more{i}" for i in range(30)) + "." for m, _ in marks]
    rows = line_rules.measured(spark.createDataFrame(list(enumerate(long + short)), "doc_id long, text string")).collect()
    got = {r["doc_id"]: r for r in rows}
    for i, (_, kept) in enumerate(marks):
        assert got[i]["kept"] == kept and (got[i]["clean_text"] == long[i]) == kept
    assert all(sum(got[len(long) + i]["line_faults"].values()) == 1 for i in range(len(short)))


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(BLANK, lowered)
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows, bits=4):
    ids = [r[0] for r in rows]
    fps = [fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {g: min((ids[i] for i in range(len(rows)) if group[i] == g and ids[i] is not None), default=None) for g in set(group)}
    return Counter((ids[i], f"{fps[i]:016x}", least[group[i]]) for i in range(len(rows)))


def near_copies(n):
    """Near copies of one text in a chain and apart, with short texts whose fingerprints differ in few bits."""
    rng = random.Random(5)
    body = prose(rng, 400).split()
    rows = []
    for i in range(n):
        body[rng.randrange(len(body))] = f"x{i}"
        rows.append((i, " ".join(body), "en", "a", 1))
    return rows + [(n + i, prose(rng, 50), "en", "a", 1) for i in range(20)] + [(None, rows[0][1], None, None, None)]


@pytest.mark.parametrize("options", [{}, {"parts": 5}, {"parts": 8}, {"slice_rows": 3}])
def test_near_duplicates_are_those_of_all_pairs(spark, options):
    rows = near_copies(60) + odd_rows()
    df = clashing(spark.createDataFrame(rows, SCHEMA), "fp", "component_id")
    got = Counter(tuple(r) for r in pivots.near_duplicates(df, **options).collect())
    assert got == classes(rows)


def test_one_document_of_a_component_stays(spark):
    rows = near_copies(30) + odd_rows()
    kept = pivots.one_per_component(spark.createDataFrame(rows, SCHEMA)).collect()
    want = {c for _, _, c in classes(rows) if c is not None}
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(want)
    # rows without an id stay only where their component has none with one
    alone = [c for _, _, c in classes(rows) if c is None]
    assert sum(r["doc_id"] is None for r in kept) == len(set(map(str, alone)))
    assert pivots.one_per_component(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("doc_id", [None, 7])
def test_one_text_of_a_component_stays_whatever_the_ids(spark, doc_id):
    """All ids null, or all equal: unrelated texts stay, copies and near copies leave one."""
    rng = random.Random(9)
    apart = [prose(rng, 60, [f"w{i}" for i in range(500)]) for _ in range(6)]
    rows = [(doc_id, t, "en", "a", None) for t in apart + apart[:3] + [apart[0] + " " + apart[0], None, ""]]
    kept = pivots.one_per_component(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    found = {r["text"] for r in kept}
    assert len(kept) == len(found) == 7 and set(apart[1:]) < found and len(found & {None, ""}) == 1


ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def contamination(text, items):
    low = lambda t: re.findall(ALNUM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, ids = low(text), set(), set()
    for item, t in items:
        v = low(t)
        n = min(10, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1 if v else 0):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                ids.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("options", [{}, {"block_words": 40}, {"k": 10}, {"k": 1}])
def test_shared_spans_are_all_shared_windows(spark, options):
    rng = random.Random(7)
    items = [(i, prose(rng, rng.choice([3, 8, 10, 11, 30]), [f"v{j}" for j in range(5)])) for i in range(12)] + [(1, None), (50, ""), (None, prose(rng, 20)), (51, "Été Ünï 12"), (52, "été ünï 12")]
    texts = [prose(rng, 25, [f"v{j}" for j in range(5)]) + ", " + (items[rng.randrange(12)][1] or "") + "; " + prose(rng, 5) for _ in range(30)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + odd_rows() + [(99, "xx Été—Ünï 12 yy", None, None, None), (99, "été ünï 12", None, None, None)]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "found", "item_id")
    got = winnowing.shared_spans(df, spark.createDataFrame(items, "item_id long, text string"), **options)
    got = Counter(str((r[0], r[1], r[2], sorted(r[3]))) for r in got.select("doc_id", "found.n_words", winnowing.hit_words(got.found), "found.items").collect())
    assert got == Counter(str((r[0], *contamination(r[1], items))) for r in rows)


def test_long_items_are_cut_into_overlapping_segments(spark, monkeypatch):
    monkeypatch.setattr(winnowing, "SEGMENT_WORDS", 16)
    item = " ".join(f"n{i}" for i in range(100))
    rows = [(s, " ".join(f"n{i}" for i in range(s, s + 10)), None, None, None) for s in range(0, 90)]
    got = winnowing.shared_spans(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {tuple(r) for r in got.select("found.n_words", winnowing.hit_words(got.found)).collect()} == {(10, 10)}


def test_decontaminated_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert winnowing.decontaminated(odd(spark), none).count() == len(odd_rows())
    assert winnowing.decontaminated(spark.createDataFrame([], SCHEMA), none).count() == 0
