"""Hard negatives, quality rules and the conversation trie against brute-force versions, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import hard_negatives, jaccard_join, prefix_trie, quality_rules

# --- hard negatives -------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label int, row string, part int, rank int"


def vectors(n: int = 700, seed: int = 4) -> list[tuple]:
    rng = random.Random(seed)
    out: list[tuple] = [(i, [rng.gauss(0, 0.3) for _ in range(6)], rng.randrange(4)) for i in range(n)]
    same = [0.5, -0.25, 0.125, 0.0, 0.25, -0.5]
    out += [(1000 + i, list(same), i % 3) for i in range(150)]  # equal vectors: ties everywhere
    out += [(200, [0.3] * 6, 1), (200, [0.3] * 6, 1), (300, [0.2, -0.2], 2), (400, [], 3), (500, [1.0] * 9, 0)]
    out += [(600, None, 1), (None, [0.1] * 6, 1), (601, [0.1, None], 1), (602, [float("nan")] * 6, 1), (603, [float("inf")] * 6, 2), (604, [0.1] * 6, None)]
    out += [(2100, [0.4] * 6, 99)]  # the only one of its label: no positives; 2100 % 7 == 0 moves it to label 0
    out += [(2200, [0.4] * 6, 77), (-100, [0.9] * 6, 2)]
    return out


def plain_negatives(rows: list[tuple]) -> Counter:
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(256 * x) for x in vector], (label + 1) % 10 if vec_id % 7 == 0 else label))
    out: Counter = Counter()
    for a, (anchor, x, label) in enumerate(kept):
        if anchor % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), vec_id, i) for i, (vec_id, y, _) in enumerate(kept))
        positives = [s for s in scored if s[2] != a and kept[s[2]][2] == label][:5]
        for p, positive, _ in positives:
            fits = [(s, v) for s, v, i in scored if kept[i][2] != label and 30 * -p <= 100 * -s <= 90 * -p][:10]
            out.update((anchor, positive, r, v, -p, -s) for r, (s, v) in enumerate(fits, 1))
    return out


def found_negatives(spark, rows, **bounds) -> Counter:
    df = spark.createDataFrame([(*r, "x", 7, 8) for r in rows], VECTORS).repartition(3)
    return Counter(tuple(r) for r in hard_negatives.hard_negatives(df, **bounds).collect())


def test_hard_negatives_equal_brute_force(spark):
    rows = vectors()
    want = plain_negatives(rows)
    assert found_negatives(spark, rows) == want and len(want) > 200
    assert found_negatives(spark, rows, shard_rows=40, anchor_rows=3) == want  # many shards, blocks and ranges of equal rows


@pytest.mark.parametrize("most", [1e4, 1e6, 8e6])  # products exact as doubles, as longs, and as whole numbers of any size only
def test_hard_negatives_of_large_numbers(spark, most):
    rng = random.Random(1)
    large = [(i, [rng.uniform(-most, most), rng.uniform(-most, most)], i % 2) for i in range(0, 2000, 10)]
    want = plain_negatives(large)
    assert found_negatives(spark, large) == want and len(want) > 20


def test_hard_negatives_of_empty_tables(spark):
    assert found_negatives(spark, []) == Counter()
    assert found_negatives(spark, [(100, None, 1)]) == Counter()


def test_best_first_opens_few_boxes_of_clustered_rows(monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 8)) * 300
    x = (np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 8))).astype(np.int64)
    tree = hard_negatives.Tree(np.arange(4000), np.arange(4000), np.zeros(4000, np.int64), x)
    low, high = tree.low[: tree.leaves, 1:], tree.high[: tree.leaves, 1:]
    for leaf in range(tree.leaves):
        own = tree.vectors[tree.first[leaf] : tree.last[leaf]]
        assert (own >= low[leaf]).all() and (own <= high[leaf]).all() and len(own) <= hard_negatives.LEAF
    vectors_, queries = hard_negatives.exact(tree.vectors, x[:50])
    least, most = tree.bounds(queries)
    opened = []
    for i in range(50):
        def rows(here, opened=opened):
            opened.append(here)
            return np.ones(here.stop - here.start, bool)

        best = hard_negatives.best_first(tree, vectors_, queries[i], least[i], most[i], lambda n: True, rows, [(-(10**18), 10**18)], 5)[0]
        scores = x @ x[i]
        assert [(s, r) for s, r, _ in best] == sorted(zip((-scores).tolist(), range(4000)))[:5]
    assert len(opened) < 50 * tree.leaves / 3


# --- quality rules ----------------------------------------------------------------

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, n_words int, failed int"
SYMBOLS = re.compile(r"[#*$%&|<>]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(seed: int = 9) -> list[tuple]:
    rng = random.Random(seed)
    out: list[tuple] = []
    for i in range(400):
        short = i % 2  # one source has much shorter words
        words = ["abcdefghij"[: rng.randint(2, 3 if short else 8)] + rng.choice("klmno") for _ in range(rng.randint(5, 200))]
        out.append((i, " ".join(words), ["en", "de", None][i % 3], ["web", "books", None, "rare"][min(i % 8, 3)] if i > 5 else f"one{i}"))
    line = "the same line again and again in every place"
    out += [(500, "\n".join([line] * 30), "en", "web"), (501, "# $ " * 60, "en", "web"), (502, "x" * 50_000, "en", "web"), (503, "w " * 20_000, "en", "web")]
    out += [(504, None, "en", "web"), (505, "", None, None), (506, " \n\t", "de", "books"), (507, "ä ö ü 😀 " * 30, "en", "web"), (508, "a\n\na\n b\na", "en", "web")]
    out += [(None, "no id here " * 10, "en", "web"), (500, "another text of five hundred", "en", "web"), (7, out[7][1], *out[7][2:])]
    return out


def plain_counts(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), len(covered)


def plain_rules(rows: list[tuple]) -> Counter:
    rules = [("word_length", 1, 5000, True), ("symbols", 2, 1000, False), ("repeated_lines", 3, 500, False), ("repeated_words", 4, 3000, False)]
    counts = [plain_counts(r[1]) for r in rows]

    def cut(v):
        shift = max(v.bit_length() - 8, 0)
        return v >> shift << shift

    def quartiles(values):
        values = sorted(map(cut, values))
        return values[math.ceil(len(values) / 4) - 1], values[math.ceil(len(values) * 3 / 4) - 1]

    groups = defaultdict(list)
    for r, c in zip(rows, counts):
        if c[0]:
            for level in ((r[2], r[3]), (r[2],), ()):
                groups[level].append(c)
    out: Counter = Counter()
    for r, c in zip(rows, counts):
        failed = []
        if c[0]:
            group = next(g for g in ((r[2], r[3]), (r[2],), ()) if len(groups[g]) >= 50 or g == ())
            for name, at, gap, both in rules:
                q1, q3 = quartiles([10_000 * x[at] // x[0] for x in groups[group]])
                v, reach = 10_000 * c[at] // c[0], max(4 * (q3 - q1), gap)
                if v > q3 + reach or both and v < q1 - reach:
                    failed.append(name)
        base = c[0] < 20 or 100 * c[4] > 30 * c[0]
        out[(r[0], *c, base, ",".join(failed), not base and not failed)] += 1
    return out


def test_quality_rules_equal_brute_force(spark):
    rows = documents()
    df = spark.createDataFrame([(*r, 1, "k", 2, 3) for r in rows], DOCS).repartition(3)
    got = quality_rules.quality_rules(df).drop("lang", "source")
    want = plain_rules(rows)
    assert Counter(tuple(r) for r in got.collect()) == want
    verdicts = {k[0]: k for k in want}
    assert "symbols" in verdicts[501][-2] and "word_length" in verdicts[502][-2] and "repeated_lines" in verdicts[508][-2]
    assert 0.4 < sum(n for k, n in want.items() if k[-1]) / len(rows) < 0.95


def test_quality_rules_of_an_empty_table(spark):
    assert quality_rules.quality_rules(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("words", [["a"] * 9, list("abcdefgh"), list("abcdefghabcdefgh"), list("abcdefghxabcdefgh"), list("abcdefgabcdefg"), [], ["a"] * 8])
def test_repeated_words(words):
    assert quality_rules.repeated_words([w.encode() for w in words]) == plain_counts(" ".join(words))[4]


def test_sketches_merge_in_any_order(spark):
    rows = [(i, "ab " * (20 + i % 50), f"l{i % 2}", f"s{i % 7}", 1, "k", 2, 3) for i in range(300)]
    sketch = quality_rules.sketched(quality_rules.measures(spark.createDataFrame(rows, DOCS)))
    direct = quality_rules.sketched(quality_rules.measures(spark.createDataFrame(rows, DOCS)).withColumn("source", F.lit(None).cast("string")))
    merged = quality_rules.quartiles(sketch, "lang").collect()
    assert sorted(merged) == sorted(quality_rules.quartiles(direct, "lang").collect()) and len(merged) == 8


# --- conversation trie ----------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, k1 int, n_convs int"


def conversations(seed: int = 6) -> list[tuple]:
    rng = random.Random(seed)
    out: list[tuple] = []
    for c in range(60):
        for t in range(rng.randint(1, 7)):
            out.append((c, t, rng.choice(["user", "assistant"]) if t else "system", rng.choice(["yes", "no", "grüß dich", "", None])))
    long = [(t, "user", f"turn {t % 90}") for t in range(700)]
    out += [(c, *turn) for c in (100, 101, 103) for turn in long]  # deep, one of them leaves the others in the middle
    out += [(102, t, role, "fork" if t == 333 else text) for t, role, text in long]
    out += [(200, None, "user", "first"), (200, 0, None, "second"), (201, 0, "user", "only"), (207, 3, "user", "no family"), (207, 9, "user", "later")]
    out += [(-3, 1, "user", "yes"), (None, 1, "user", "nobody's"), (10**12, 1, "user", "yes"), (10**12 + 1, 1, "user", "yes")]
    return out


def plain_trie(rows: list[tuple]) -> Counter:
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        family = c - int(math.fmod(c, 5))
        rebuilt[c] = own.get(family, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        children[node[:-1]] += bool(node)
    for node, convs in members.items():
        worth = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += worth
    ends = {n: hashlib.sha256(",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(n)))).encode()).hexdigest() for n, convs in members.items()}
    return Counter(
        (min(convs), len(n), min(members[n[:-1]]) if n else None, len(convs), children[n], leaves[n], saved[n], ends[n]) for n, convs in members.items()
    )


def found_trie(spark, rows) -> Counter:
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURNS).repartition(3)
    return Counter(tuple(r) for r in prefix_trie.prefix_trie(df).collect())


def test_trie_equals_brute_force(spark):
    rows = conversations()
    want = plain_trie(rows)
    assert found_trie(spark, rows) == want and max(k[1] for k in want) == 700


def test_trie_in_short_pieces_and_bands(spark, monkeypatch):
    """Conversations longer than a piece, and a trie of several levels of bands."""
    monkeypatch.setattr(prefix_trie, "BAND", 4)
    monkeypatch.setattr(prefix_trie, "PIECE", 16)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = [r for r in conversations() if (r[1] or 0) < 75]
    assert found_trie(spark, rows) == plain_trie(rows)


def test_trie_of_copies_ties_and_nothing(spark):
    copies = [(c, t, "user", f"text {t}") for c in range(0, 300) for t in range(3)]
    assert found_trie(spark, copies) == plain_trie(copies)
    assert found_trie(spark, []) == Counter() and found_trie(spark, [(None, 1, "user", "x")]) == Counter()
    twice = found_trie(spark, [(5, 1, "user", "a"), (5, 1, "user", "a"), (5, 1, "user", "b")])  # turns of one number, two of them equal
    assert Counter(k[1] for k in twice) == Counter({0: 1, 1: 1, 2: 1, 3: 1})


# --- near copies: rows of their own, keys that linked sets share ---------------------


def test_repeated_and_null_ids_keep_their_own_rows(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    near = lambda k: " ".join(base[:-k] + ["changed"] * k)
    rows = [(3, " ".join(base), "a"), (5, near(1), "b"), (5, "another text of five here", "c"), (None, near(2), "d"), (None, "another text of nobody at all", "e")]
    rows += [(7, "a copy that stays once only", "f"), (7, "a copy that stays once only", "f"), (8, None, "g"), (9, "", "h")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n string").repartition(3)
    kept = jaccard_join.one_of_each(docs, 5, Fraction(4, 5))
    assert kept.columns == docs.columns
    assert Counter(r["n"] for r in kept.collect()) == Counter("acefgh")


@pytest.mark.parametrize("least", [Fraction(4, 5), Fraction(9, 10)])
def test_linked_sets_share_a_key(least):
    rng = np.random.default_rng(8)
    shared = total = 0
    for _ in range(1500):
        n = int(rng.integers(5, 600))
        own = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        gone = int(n * rng.random() * (1 - float(least)))
        added = rng.integers(1, 1 << 63, int(n * rng.random() * (1 - float(least))), dtype=np.uint64)
        other = np.concatenate((own[gone:], added))
        if least.denominator * (n - gone) < least.numerator * (n + len(added)) or not gone + len(added):
            continue
        x, y = (np.unique(s) for s in (own, other))
        total += 1
        shared += bool(set(jaccard_join.part_keys(x, least)) & set(jaccard_join.part_keys(y, least)))
    assert shared == total > 300


def test_unrelated_sets_share_no_keys():
    """Keys grow with the rows, and so do candidates: none at all among sets with nothing in common."""
    rng = np.random.default_rng(5)
    for rows in (500, 1000, 2000):
        sizes = rng.integers(5, 400, rows)
        keys = np.concatenate([np.unique(jaccard_join.part_keys(rng.integers(1, 1 << 63, n, dtype=np.uint64), Fraction(4, 5))) for n in sizes])
        assert len(np.unique(keys)) == len(keys) < 0.8 * sizes.sum() + 3 * rows
