"""The pipeline operators on small tables: edge cases, and brute-force versions of their results."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillwise.llm import bpe, decontaminate, exact_dedup, jaccard_join, katz, kneser_ney, licenses, pii, token_files, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept int, digest string, node int, key string"
WORDS = [a + b + c for a in "bdkl" for b in "aeiou" for c in ("n", "r", "st", "m")]


def texts(seed: int = 5) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    out: list[tuple[int | None, str | None]] = []
    for i in range(120):
        out.append((i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 120)))))
    base = [rng.choice(WORDS) for _ in range(200)]
    for i in range(200, 260):  # near copies with one or two words changed
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(200)] = rng.choice(WORDS)
        out.append((i, " ".join(copy)))
    out += [(300, out[3][1]), (301, out[3][1].replace(" ", "\n\t", 1)), (302, None), (303, ""), (304, "  \n"), (305, "one"), (306, "One two")]
    out += [(307, "x" * 50_000), (308, " ".join(["again"] * 20_000)), (None, "a row without id"), (None, None), (5, out[5][1]), (5, "another text of five")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 1, 1, "d", 2, "k") for i, t in texts()], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe_equals_library(docs, empty):
    from tokenizers import Tokenizer

    path = bpe.word_vocabulary()
    library = Tokenizer.from_file(path)
    for r in bpe.encode_decode(docs, path).collect():
        assert library.decode(r["ids"], skip_special_tokens=False) == r["decoded"]
    by_text = Counter(tuple(r["ids"]) for r in bpe.encode_decode(docs, path).collect())
    assert by_text == Counter(tuple(library.encode(t or "", add_special_tokens=False).ids) for _, t in texts())
    assert bpe.encode_decode(empty, path).count() == 0
    rng = random.Random(1)
    vocab = bpe.WordBpe(path)
    for _ in range(2000):
        t = "".join(rng.choice("abcΣσİßÀé \t\n\x1c\xa0'sTl12<|endoftext|>😀漢.,!") for _ in range(rng.randint(0, 30))) + rng.choice(["", "<|endoftext|>", " I'LL"])
        ids = library.encode(t, add_special_tokens=False).ids
        assert vocab.encode(t).tolist() == ids and vocab.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_token_files_round_trip(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = token_files.read_token_files(token_files.write_token_files(docs, path, shard_ids=3000)).collect()
    start = 0
    order = sorted(texts(), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode()))
    assert len(rows) == len(order)
    for (i, t), r in zip(order, sorted(rows, key=lambda r: r["start"])):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_files.read_token_files(token_files.write_token_files(empty, path)).count() == 0


def test_shard_random_access():
    rng = np.random.default_rng(3)
    ids = np.concatenate((rng.integers(0, 9, 4000), np.zeros(500, int), rng.integers(0, 60000, 300))).astype("<u2")
    starts = np.array([0, 1, 1500, 4100])
    shard = token_files.Shard(token_files.write_shard(ids, starts, 1 << 16))
    assert len(shard.symbols) < len(ids) and len(shard.rules)
    assert [shard.document(i).tolist() for i in range(4)] == [x.tolist() for x in np.split(ids, starts[1:])]
    for a, b in [(0, 1), (17, 2900), (1499, 1501), (4799, 4800), (5, 5)]:
        assert shard.read_ids(a, b).tolist() == ids[a:b].tolist()


def test_exact_dedup(docs, empty, spark):
    import re

    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for i, t in texts():
        groups[norm(t)].append(i)
    rows = exact_dedup.exact_dedup(docs).collect()
    want = Counter()
    for i, t in texts():
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = min(ids, default=None)
        want[i, hashlib.sha256(norm(t).encode()).hexdigest(), keep, len(groups[norm(t)]), i == keep] += 1
    assert Counter(map(tuple, rows)) == want
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(r["text"] for r in kept.collect()).most_common(1)[0][1] == 1
    assert exact_dedup.exact_dedup(empty).count() == 0
    many = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i % 50}") for i in range(900)], "doc_id int, text string")
    assert {r["group_size"] for r in exact_dedup.exact_dedup(many).where("doc_id % 3 != 0").collect()} == {600}


def links(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    names = defaultdict(list)
    for x, (i, _) in enumerate(rows):
        if i is not None:
            names[root(x)].append(i)
    return Counter((i, len(sets[x]), min(names[root(x)], default=None) if sets[x] else i) for x, (i, _) in enumerate(rows))


def test_jaccard_join(docs, empty):
    assert Counter(map(tuple, jaccard_join.jaccard_join(docs).collect())) == links(texts())
    assert jaccard_join.jaccard_join(empty).count() == 0
    assert jaccard_join.one_of_each(docs).columns == docs.columns


def near_copies(seed: int = 8) -> list[tuple[int, str]]:
    """Texts, each with a copy that has a footer and one with some words changed."""
    rng = random.Random(seed)
    out = []
    for i in range(40):
        base = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(rng.choice([7, 9, 14, 60, 250]))]
        footer = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(len(base) * 15 // 100)]
        changed = list(base)
        for _ in range(rng.randint(1, max(1, len(base) // 25))):
            changed[rng.randrange(len(base))] = "other"
        out += [(3 * i, " ".join(base)), (3 * i + 1, " ".join(base + footer)), (3 * i + 2, " ".join(changed))]
    return out


def test_near_copies_of_the_pipeline(spark):
    import corpus_pipeline

    rows = near_copies()
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    name = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((name[a], name[b]))
                name = [low if x == high else x for x in name]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    stage = dict(corpus_pipeline.STAGES)["n-gram jaccard join"]
    kept = {r["doc_id"] for r in stage(spark, table, "").collect()}
    assert kept == {i for i, _ in rows if name[i] == i}
    assert len(kept) < jaccard_join.one_of_each(table).count() < len(rows)


def test_katz_keeps_rows_apart_and_does_not_depend_on_shards(spark, docs, monkeypatch):
    """Ids and texts that swap places with a null are rows of their own; many shards sum to the same."""
    swapped = spark.createDataFrame([("a b c", None), (None, "a b c")], "doc_id string, text string")
    assert sorted(r["n_tokens"] for r in katz.katz_scores(swapped, F.lit(True)).collect()) == [1, 4]

    def scores():
        rows = katz.katz_scores(docs, F.lit(True)).collect()
        return sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in rows)

    whole = scores()
    monkeypatch.setattr(katz, "SHARD_TOKENS", 40)
    assert scores() == whole


def test_katz_blocks_keep_documents_apart(monkeypatch):
    """Positions, documents, keys and marks of blocks of slices are those of the texts one by one."""
    texts = ["b a b", None, "", "a " * 40, "c", "b a b"]
    batch = pa.record_batch({"text": texts, "key": list(range(6)), "training": [True, False, True, True, False, True]})
    want = [(k, *pair) for k, t in enumerate(texts) for pair in zip(*(x.tolist() for x in katz.tokens([t])[:2]))]
    for most in (1, 30, 1 << 20):
        monkeypatch.setattr(katz, "BLOCK_BYTES", most)
        monkeypatch.setattr(katz, "BLOCK_DOCS", 2 if most == 30 else 16_000)
        got = []
        for u, w, doc, keys, marks in katz._blocks(iter([batch.slice(0, 2), batch.slice(2, 3), batch.slice(5)])):
            assert len(keys) <= katz.BLOCK_DOCS
            assert marks.tolist() == [k not in (1, 4) for k in keys.tolist()]
            got += zip(keys[doc].tolist(), u.tolist(), w.tolist())
        assert got == want


def test_bpe_queue_and_cache():
    """The queue's merges equal a plain scan for the least rank; a full cache of two generations forgets no result."""
    vocab = bpe.WordBpe(bpe.word_vocabulary())
    for word in ("a", "hello", "aaaaaaaaaaaaaaaaa", "ababababab" * 30, "mississippi", "straße", "日本語日本語", "!!!!!!!", "'s"):
        raw = word.encode()
        ids = [vocab.inner[b] for b in raw[:-1]] + [vocab.final[raw[-1]]]
        while True:
            pairs = enumerate(a << bpe.ID_BITS | b for a, b in zip(ids, ids[1:]))
            ranks = [(vocab.ranks[k], i) for i, k in pairs if k in vocab.ranks]
            if not ranks:
                break
            rank, i = min(ranks)
            ids[i : i + 2] = [vocab.made[rank]]
        assert vocab.encode_word(word) == ids, word
    calls = []
    cache = bpe.Recent(lambda k: calls.append(k) or [k], 3)
    for k in (0, 1, 2, 3, 0, 4, 5, 6, 7, 0):
        assert cache[k] == [k]
    assert calls[:8] == [0, 1, 2, 3, 4, 5, 6, 7] and len(cache) <= 3 and len(cache.older) <= 3


def test_katz_is_exact_and_normalised(docs, empty):
    training = F.coalesce(F.col("doc_id") % 4 != 0, F.lit(True))
    rows = katz.katz_scores(docs, training).collect()
    uni, bi = Counter(), Counter()
    split = lambda t: [*(t or "").encode().lower().split(), b" end"]
    used = [split(t) for i, t in texts() if i is None or i % 4]
    for t in used:
        uni.update(t)
        bi.update(zip([b" start", *t[:-1]], t))
    amounts = lambda c: katz.good_turing([Counter(c.values())[r] for r in range(1, katz.K + 2)])
    wl, pl, total = amounts(uni), amounts(bi), sum(uni.values())
    less = lambda c, a: a[min(c, katz.K) - 1]
    unknown = sum(less(c, wl) for c in uni.values()) / total
    own = lambda w: (uni[w] - less(uni[w], wl)) / total if uni[w] else unknown
    assert math.isclose(sum(map(own, uni)) + unknown, 1)
    gone, shown, size = defaultdict(float), defaultdict(float), Counter()
    for (u, w), c in bi.items():
        gone[u] += less(c, pl)
        shown[u] += own(w)
        size[u] += c

    def probability(u, w):
        if bi[u, w]:
            return (bi[u, w] - less(bi[u, w], pl)) / size[u]
        return (gone[u] / size[u] / (1 - shown[u]) if size[u] else 1) * own(w)

    for u in list(size)[:10]:
        assert math.isclose(sum(probability(u, w) for w in uni) + probability(u, b"never"), 1, rel_tol=1e-9)
    want = defaultdict(list)
    for i, t in texts():
        w = split(t)
        want[i].append((len(w), sum(uni[x] > 0 for x in w), sum(math.log10(probability(u, x)) for u, x in zip([b" start", *w[:-1]], w))))
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["n_tokens"], r["n_known"], r["score"]))
        assert r["train_tokens"] == total
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in want.items()}
    for i in want:
        for a, b in zip(sorted(want[i]), sorted(got[i])):
            assert a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-9)
    assert katz.katz_scores(empty, training).count() == 0


def test_decontamination(spark, docs):
    item = "A train leaves at 9 with Anna aboard and after 12 km it meets Boris who waited 9 minutes near the old red bridge"
    other = "unter der alten roten Brücke"
    again = item.replace("Anna", "Carla").replace("Boris", "Dmitri").replace("9", "7").replace("12", "35")
    mixed = again.replace("waited 7", "waited 8")  # the same number became two
    pad = "some words before it. "
    rows = [(1, pad + item + " and more"), (2, pad + again), (3, pad + mixed), (4, "clean text of its own"), (5, None), (6, pad + other.upper().lower()),
            (7, pad + other), (7, "a second row of seven"), (None, item), (8, " ".join(item.split()[:6]))]
    table = spark.createDataFrame(rows, "doc_id int, text string")
    bench = spark.createDataFrame([(1, item, "x"), (2, other, "x"), (2, item, "x"), (3, None, "x"), (4, "", "x"), (4, "", "x")], "item_id int, text string, doc_id string")
    found = {r["doc_id"] for r in decontaminate.contaminated(table, bench).collect()}
    assert found == {1, 2, 7, None}
    assert sorted(r["doc_id"] for r in decontaminate.clean_documents(table, bench).collect()) == [3, 4, 5, 6, 8]
    assert decontaminate.contaminated(table, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(table.limit(0), bench).count() == 0


def test_decontamination_finds_edited_items(spark):
    item = "A train leaves at 9 with Anna aboard and after 12 km it meets Boris who waited 9 minutes near the old red bridge"
    words = item.split()
    put, gone, two = list(words), list(words), list(words)
    put.insert(12, "suddenly")
    del gone[8]
    two[8], two[18] = "afterwards", "beside"
    start = "Anna has 12 red apples and gives five of them to her younger brother"
    short = "What is the capital of France?"
    pad = "Some words of no matter stand here before it and go on for a while "
    rows = [
        (1, pad + " ".join(put)), (2, pad + " ".join(gone) + " " + pad), (3, pad + " ".join(two)), (4, "Then: " + start.replace("Anna", "Dmitri").replace("12", "7")),
        (5, "Question: " + short), (6, pad + short), (7, "a fine day"), (8, pad + "is the capital far away"), (9, (pad * 3000) + item + " " + pad * 500),
        (10, " ".join(words[:8]) + " " + pad * 2 + " ".join(words[8:12])),  # a third of the item
        (11, " ".join(w for pair in zip(words, ["x", "y", "z"] * 8) for w in pair)),  # no window is left
    ]
    table = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows], "doc_id int, text string, id int, item string, low int, width int")
    bench = spark.createDataFrame([(1, item, 7), (2, start, 7), (3, short, 7), (4, "fine", 7)], "item_id int, text string, at int")
    found = {r["doc_id"]: r["items"] for r in decontaminate.contaminated(table, bench).collect()}
    assert found == {1: [1], 2: [1], 3: [1], 4: [2], 5: [3], 6: [3], 9: [1]}
    kept = decontaminate.clean_documents(table, bench)
    assert kept.columns == table.columns and sorted(r["doc_id"] for r in kept.collect()) == [7, 8, 10, 11]


def test_decontamination_windows_lie_in_one_text(spark):
    """Windows of texts taken together are those of each text alone."""
    some = ["One two. Three 4 km Five", None, "", "six", "Seven eight nine Ten eleven. Twelve 13 14 km 15", "a b c d e f"]
    together = decontaminate.tokens(some)
    for whole in (False, True):
        got = defaultdict(Counter)
        for w in decontaminate.windows(together, decontaminate.WIDTHS, whole):
            first = w.form.bounds[w.first]
            for text, at, h in zip(together.text[first].tolist(), together.at[first].tolist(), w.hashes.tolist()):
                got[text][at, h] += 1
        for i, text in enumerate(some):
            alone = decontaminate.tokens([text])
            want = Counter()
            for w in decontaminate.windows(alone, decontaminate.WIDTHS, whole):
                want.update(zip(alone.at[w.form.bounds[w.first]].tolist(), w.hashes.tolist()))
            assert got[i] == want


def test_licenses(docs, empty):
    n, starts, base, found = licenses.scan("Free. Under the MIT License! (Apache License, Version 2.0) under the mit license CC BY-NC 4.0")
    assert (n, sorted(starts), base) == (19, [1, 5, 10, 14], ["mit", "apache-2", "cc-by-nc"])
    assert {"mit", "apache-2", "cc-by-nc"} <= {f.label for f in found}
    labels = lambda t: {f.label for f in licenses.scan(t)[3]}
    assert labels("This is licensed under the GNU General Public License, version 3.") == {"gpl-3"}  # the bare title lies inside
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == {"bsd-3-clause"}
    assert labels("http://creativecommons.org/licenses/by-sa/4.0") == {"cc-by-sa"}
    assert labels("the apache rode under the sun with permission") == set()
    assert licenses.scan(None) == (0, [], [], []) and licenses.scan("Ünder—the") == (1, [], [], [])
    assert len(licenses.rules()) > 200
    assert licenses.scan_licenses(docs).count() == len(texts()) and licenses.scan_licenses(empty).count() == 0


def ways(parsed) -> list[str]:
    """Texts of a pattern: each alternative of each part at least once, the other parts at their first."""
    from re import _parser as p

    parts = []
    for kind, value in parsed:
        if kind is p.LITERAL:
            parts.append([chr(value)])
        elif kind is p.IN:
            parts.append([chr(x if k is p.LITERAL else x[0]) for k, x in value])
        elif kind is p.BRANCH:
            parts.append([t for way in value[1] for t in ways(way)])
        elif kind is p.SUBPATTERN:
            parts.append(ways(value[-1]))
        elif kind is p.MAX_REPEAT:
            parts.append([t * n for n in {value[0], max(1, value[0])} for t in ways(value[-1])])
        elif kind is p.ANY:
            parts.append(["x"])
    return ["".join(x[i if k == j else 0] for k, x in enumerate(parts)) for j, y in enumerate(parts) for i in range(len(y))] or [""]


def test_license_prefilter_leaves_out_no_rule():
    from re import _parser

    for r in licenses.rules():
        assert r.needs
        for text in set(ways(_parser.parse(r.pattern.pattern.decode().removeprefix("(?<= )").removesuffix("(?= )")))):
            line = f" {text} ".encode()
            may = set(licenses.tried(line))
            assert {x for x in licenses.rules() if x.pattern.search(line)} <= may, text
    labels = lambda t: {f.label for f in licenses.scan(t)[3]}
    assert labels("released under the Expat License") == {"mit"}
    assert labels("licensed under the Open Database License") == {"odbl-1"}
    assert labels("licensed under the Open Data Commons Attribution License") == {"odc-by-1"}
    assert "cc-by-sa" in labels("licensed under Creative Commons Attribution ShareAlike")
    assert "cc0-1" in labels("licensed under Creative Commons Zero")
    assert labels("a GNU GPL notice") == {"gpl"} and labels("a GNU LGPL notice") == {"lgpl"} and labels("a GNU AGPL notice") == {"agpl"}
    assert labels("see mozilla.org/MPL/2.0") == {"mpl-2"}


def test_toxicity_on_held_out_texts(spark):
    rng = random.Random(2)
    insults = ["moronik", "stupidoz", "clownish"]
    rows = []
    for i in range(600):
        words = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(40)]
        if i % 4 == 0:
            words[rng.randrange(40)] = rng.choice(insults)
        rows.append((i, " ".join(words), i % 4 == 0))
    model = toxicity.train([t for i, t, _ in rows if i < 400], [int(y) for i, _, y in rows if i < 400])
    found = model.score(toxicity.document_margins(model, [t for i, t, _ in rows if i >= 400])) >= toxicity.THRESHOLD
    truth = np.array([y for i, _, y in rows if i >= 400])
    assert found[truth].mean() > 0.95 and found[~truth].mean() < 0.05
    gapped = model.score(toxicity.document_margins(model, ["dan m.o.r.o.nik kor", "dan m o r o n i k kor", "dan kor", "", None]))
    assert gapped[0] > gapped[2] and gapped[1] > gapped[2] and gapped[3] == gapped[4] <= gapped[2]
    assert toxicity.train(["a", "b"], [0, 0]).score(np.array([9.0])) < 1e-9


def test_kneser_ney_is_normalised(spark, empty, docs):
    rows = [(i, " ".join(WORDS[(i * 7 + j * j) % len(WORDS)] for j in range(30)), "en" if i % 2 else None) for i in range(60)]
    sample = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = kneser_ney.load(kneser_ney.train(sample))
    letters = sorted({c for _, t, _ in rows for c in t})
    for context in ("\x02\x02\x02\x02", "\x02\x02\x02b", " ban", "zzzz"):
        mass = sum(2 ** model.log_p(np.frombuffer((context + c).encode("utf-32-le"), np.uint32), "en")[0] for c in [*letters, "§"])
        assert math.isclose(mass, 1, rel_tol=1e-6)
    assert model.perplexity(rows[1][1], "en") < model.perplexity("zq!x #7 %%", "en")
    assert model.perplexity(None, "en") is None and model.perplexity("abc", "xx") is None
    trusted = sample.select("doc_id").where("doc_id < 50")
    out = kneser_ney.quality(sample.unionByName(spark.createDataFrame([(99, "%$ zz QQ ## qq", "en"), (98, None, "en"), (97, "x", "fr")], sample.schema)), trusted)
    kept = {r["doc_id"]: r["kept"] for r in out.collect()}
    assert len(kept) == 63 and not kept[99] and kept[98] and kept[97] and sum(kept.values()) >= 50
    assert kneser_ney.quality(empty, empty.select("doc_id")).count() == 0


def test_kneser_ney_counts_every_trusted_text(spark):
    """A passage of one trusted text among thousands is known to the model of its fold; grams keep odd letters."""
    rows = [(i, f"{i:04x} plain words of a plain text", "en") for i in range(4000)] + [(4000, "qvxz\0\0wjkq qvxz\0\0wjkq", "en")]
    sample = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    counts = {r["gram"]: r["c"] for r in kneser_ney.top_grams(sample.withColumn("fold", F.lit(0))).collect()}
    want = Counter()
    for _, t, _ in rows:
        codes = kneser_ney._plain(t)
        want.update("".join(map(chr, codes[k : k + 5])) for k in range(len(codes) - 4))
    assert counts == want
    docs = sample.unionByName(spark.createDataFrame([(5000 + i, f"qvxz\0\0wjkq qvxz\0\0wjkq {i}", "en") for i in range(8)], sample.schema))
    out = {r["doc_id"]: r for r in kneser_ney.quality(docs, docs.select("doc_id").where("doc_id <= 4000")).collect()}
    found = [out[5000 + i]["perplexity"] for i in range(8)]
    assert len(out) == 4009 and 10 * min(found) < max(found)  # one fold holds the passage, the other doesn't


def test_quality_thresholds_are_out_of_sample(spark):
    rng = random.Random(11)
    rows = [(i, " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(40)), "es") for i in range(240)]
    rows += [(i, None, "es") for i in range(240, 243)] + [(300, rows[0][1], "es")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    out = {r["doc_id"]: r for r in kneser_ney.quality(docs, docs.select("doc_id").where("doc_id < 120")).collect()}
    assert sum(not out[i]["kept"] for i in range(120, 240)) <= 12  # clean as the trusted ones
    seen, unseen = ([out[i]["perplexity"] for i in r] for r in (range(120), range(120, 240)))
    assert abs(np.mean(seen) / np.mean(unseen) - 1) < 0.05 and out[300]["perplexity"] == out[0]["perplexity"]
    assert len({r["threshold"] for r in out.values()}) == 1 and out[0]["threshold"] <= max(seen)


def test_pii(spark, empty, docs):
    rows = [(1, "Mail Bob.X1@Foo.com or bob.x1@foo.com! Call +1 (456) 555-2186 or +1 456 555 2186."), (2, "Mr. John Roe met Mrs Anna Roe; card 4041894974608795, ip 42.144.35.254."),
            (3, None), (4, ""), (5, "Г-н Иванов"), (None, "a@b.co x"), (None, "a@b.co x"), (6, "nothing 12 3.5")]
    out = {r["doc_id"]: r for r in pii.replace_pii(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    one, two = out[1]["text"], out[2]["text"]
    assert one.split()[1].lower() == one.split()[3].strip("!") and "foo" not in one.lower() and one.count("(") == 1
    digits = ["".join(filter(str.isdigit, x)) for x in (one[one.index("+") :].split(" or ")[0], one.split(" or ")[-1])]
    assert digits[0] == digits[1] != "14565552186"
    names = two.split(";")[0].split()
    assert names[0] == "Mr." and names[4] == "Mrs" and names[2] == names[6] and names[1] != names[5] and "Roe" not in two
    card = two.split("card ")[1].split(",")[0]
    luhn = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(card)))
    assert len(card) == 16 and luhn % 10 == 0
    assert out[3]["text"] is None and out[4]["text"] == "" and out[6]["text"] == "nothing 12 3.5" and out[5]["text"].startswith("Г-н ")
    assert pii.replace_pii(empty).count() == 0 and pii.replace_pii(docs).count() == len(texts())
    short = spark.createDataFrame([("name-m-latin", f"n{i}") for i in range(3000)], "type string, value string")
    known = pii.surrogates(short, "k").collect()
    assert len(known) == 3000 == len({r["surrogate"] for r in known}) and not any(r["clash"] for r in known)


def test_pipeline_keeps_columns(spark, monkeypatch):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf)
        assert docs.columns == before.columns and docs.join(before, "doc_id", "left_anti").count() == 0
    assert corpus_pipeline.run(spark, sf).count() == docs.count() > 0


def test_byte_ids_equal_library_on_odd_texts():
    vocab = token_files.byte_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    bits = [" ", " ", "\n", "\n", "\t", "\r", "\x1c", "\x85", "　", "a", "Was", "é", "日本", "23", "'", "'s", "...", "***", "$$$", "<|endoftext|>", "<", "|", ">", "_", "٣", "́", "🙂", "‍"]
    for _ in range(4000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        assert vocab.encode(text).tolist() == vocab.library.encode(text, add_special_tokens=False).ids, repr(text)
