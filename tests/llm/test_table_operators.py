"""Packing, mixing, joins, repeats, embeddings and the pipeline against plain versions."""

import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

from clickstar.llm import (  # noqa: E402
    anchors,
    components,
    embeddings,
    hnsw,
    jaccard,
    mixing,
    packing,
    repeats,
    suffixes,
)

WORDS = public_tokenizers.path("word_bpe_49k.json")


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:])))


# Packing -------------------------------------------------------------------------------------


def test_words_have_the_library_ids():
    tokenizer = Tokenizer.from_file(WORDS)
    memo = packing.WordIds(tokenizer)
    rng = random.Random(1)
    parts = [*"abcdehinort  \n\t\r\x1c'.,;12ßéΣ漢😀́", "the ", "<|endoftext|>", "don't", "　"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert memo.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_memo_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_BYTES", 1 << 20)
    tokenizer = Tokenizer.from_file(WORDS)
    memo = packing.WordIds(tokenizer)
    rng = random.Random(3)
    for n in range(300):
        # Words of hundreds of signs, as texts without spaces have.
        text = "".join(rng.choice("漢字かな交じり文") for _ in range(300)) if n % 2 else "x" * rng.randint(300, 9_000)
        assert memo.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert memo.bytes < (1 << 20) + 40_000 and len(memo.places) < 9_000


def test_packing_keeps_every_token_once(spark):
    rng = random.Random(4)
    texts = ["", None, "word " * 9_000, "ab\n" * 700]
    texts += [" ".join(rng.choice("the of and word".split()) for _ in range(rng.randint(0, 600))) for _ in range(150)]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(None, "no id", "x"), (5, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    model = Path(WORDS).read_text("utf-8")
    pieces = packing.pack_documents(docs, model, end_id=1).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    parts, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        parts[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    for key in {r[0] for r in rows}:
        own = [
            np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
            for i, t, _ in rows
            if i == key
        ]
        # Rows that share an id are told apart by their number of tokens.
        for ids in own:
            mine = sorted((p for p in parts[key] if p["doc_tokens"] == len(ids)), key=lambda p: p["start"])
            at = 0
            for p in mine:
                assert p["start"] == at
                part = ids[at : at + p["length"]]
                assert p["ids_crc32"] == zlib.crc32(part.tobytes())
                at += p["length"]
            assert at == len(ids)
    padded = total = 0
    for own in sequences.values():
        own.sort(key=lambda p: p["offset"])
        size = 0
        for p in own:
            assert p["offset"] == size
            size += p["length"]
        assert 0 < size <= 2048 and len({p["step_id"] for p in own}) == 1
        total += size
        padded += 0 if size & (size - 1) == 0 else 2048 - size
    assert padded <= 3 * 2048 and total > 30_000
    assert packing.pack_documents(docs.limit(0), model).count() == 0


# Mixing --------------------------------------------------------------------------------------


def test_targets_settle_at_their_limits(spark):
    for seed in range(12):
        rng = random.Random(seed)
        sizes = {f"s{k}" if k else None: rng.choice([0, 1, 5, 10 ** rng.randint(0, 5)]) for k in range(rng.randint(1, 9))}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
        want = brute.targets(sizes)
        assert got == pytest.approx(want), sizes


def test_mix_comes_near_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 100)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rng = random.Random(8)
    rows = [(k, rng.choice(["a", "a", "a", "b", "ç", "d", None]), "w " * rng.randint(0, 40), "x") for k in range(900)]
    rows += [rows[3]] * 50 + [(None, "b", "w w", "x"), (901, "b", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size string")
    size = mixing.word_count(F.col("text"))
    got = mixing.mix(docs, size).collect()
    again = mixing.mix(docs.repartition(7), size).collect()
    assert by_id(map(tuple, got)) == by_id(map(tuple, again))
    assert len(got) == len(rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert r["taken"] <= 3 * r["size"]
    want = brute.targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
    assert all(abs(taken[s] - want[s]) < largest[s] + 1e-6 for s in want)
    whole = mixing.mixed(docs, size)
    assert whole.columns == docs.columns
    assert whole.count() == sum(r["copies"] for r in got)
    assert mixing.mix(docs.limit(0), size).count() == 0


def test_rounding_is_fair():
    """A row's copies are its expected copies on average."""
    taken = [0] * 6
    for seed in range(3000):
        rows = [dict(chunk=0, source="a", size=s, copies=0, part=0.3, k=k) for k, s in enumerate([1, 2, 5, 9, 4, 3])]
        for r in mixing._decide(iter(rows), seed, 0, True):
            taken[r["k"]] += r["copies"]
    assert all(0.26 < t / 3000 < 0.34 for t in taken)


# Components ----------------------------------------------------------------------------------


@pytest.mark.parametrize("task_links", [1_000_000, 20])
def test_components(spark, task_links):
    rng = random.Random(6)
    links = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 40)]
    links += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7)]
    rng.shuffle(links)
    joined = brute.Joined(500)
    for a, b in links:
        joined.join(a, b)
    found = components.components(spark.createDataFrame(links, "a long, b long"), task_links)
    got = {r["node"]: r["root"] for r in found.collect()}
    least = {}
    for x in range(500):
        least.setdefault(joined.root(x), x)
    assert got == {x: least[joined.root(x)] for x in range(500) if least[joined.root(x)] != x}


# Jaccard join --------------------------------------------------------------------------------


def near_copies(rng, n):
    base = [[rng.choice("abcdefghij") + str(rng.randint(0, 60)) for _ in range(rng.randint(1, 90))] for _ in range(8)]
    passage = [f"p{k}" for k in range(25)]
    texts = []
    for _ in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 1 + len(words) // 12)):
            words[rng.randrange(len(words))] = rng.choice(["x", "Y", "z9"])
        if rng.random() < 0.3:
            at = rng.randint(0, len(words))
            words[at:at] = passage
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    return texts


@pytest.mark.parametrize("seed, task_signatures", [(1, 1_000_000), (2, 1_000)])
def test_near_duplicate_components(spark, seed, task_signatures):
    rng = random.Random(seed)
    texts = near_copies(rng, 260) + [None, "", " ", "one", "One", "a b c d", "a b c d e", "é " * 30_000]
    rows = [(k, t, "x") for k, t in enumerate(texts)]
    rows += [(None, texts[0], "x"), (3, texts[3], "x"), (3, texts[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, c string").repartition(4)
    found = jaccard.near_duplicates(docs, task_signatures=task_signatures)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()]
    want = brute.near_duplicates([r[0] for r in rows], [r[1] for r in rows])
    assert by_id(got) == by_id((r[0], *w) for r, w in zip(rows, want, strict=True))
    assert len({w[1] for w in want}) < len(rows) - 60
    kept = jaccard.one_of_each(docs, task_signatures=task_signatures)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns
    assert by_id((i,) for i in ids) == by_id((i,) for i in {w[1] for w in want})
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_loses_no_document(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "uno dos tres cuatro cinco")
    rows = [(1, a), (1, None), (1, b), (2, a), (2, c), (3, b + " seven"), (3, None), (None, a), (1, a), (4, " "), (4, " ")]
    rows = [(*r, {"k": "v"}, n, 0, 0) for n, r in enumerate(rows)]
    schema = "doc_id long, text string, __k map<string,string>, __first int, kept long, row long"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    want = [(1, a), (1, None), (1, b), (2, c), (3, None), (None, a), (4, " "), (4, " ")]
    # Two shingles of three are too few for a link.
    want.append((3, b + " seven"))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert jaccard.one_of_each(docs.limit(0)).count() == 0


def test_stages_keep_columns_of_any_name(spark):
    passage = "a passage of many words that is long enough to go " * 6
    rows = [(k, f"own {k} " + passage * (k % 2), "x", 1, 2, 3, 4) for k in range(40)] + [(None, None, None, 1, 2, 3, 4)]
    names = "doc_id long, text string, source string, __k long, __kept long, __copy long, copies long"
    docs = spark.createDataFrame(rows, names)
    left = repeats.without_repeats(docs)
    assert left.columns == docs.columns and left.count() == 41
    assert left.where("__k = 1 AND __kept = 2 AND __copy = 3 AND copies = 4").count() == 41
    assert left.where("text LIKE '%long enough%'").count() == 0
    mixed = mixing.mixed(docs, mixing.word_count(F.col("text")))
    assert mixed.columns == docs.columns
    assert mixed.where("__k = 1 AND __kept = 2 AND __copy = 3 AND copies = 4").count() == mixed.count() > 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(3)
    bands = jaccard.Bands(jaccard.Fraction(3, 4))
    common = np.sort(rng.integers(1, 1 << 63, 30).astype(np.uint64))
    for _ in range(1500):
        n = int(rng.integers(1, rng.choice([4, 12, 40, 400])))
        own = rng.integers(1, 1 << 63, n).astype(np.uint64)
        pool = np.unique(np.concatenate([own, rng.choice(common, int(rng.integers(0, 25)))]))
        most = int(len(pool) * 2 / 7) + 1
        drop = rng.integers(0, most + 1)
        other = pool[int(drop) :] if rng.random() < 0.5 else rng.permutation(pool)[int(drop) :]
        extra = rng.integers(1, 1 << 63, int(rng.integers(0, most + 1 - drop + 1))).astype(np.uint64)
        other = np.unique(np.concatenate([other, extra]))
        shared = len(np.intersect1d(pool, other))
        if shared and 4 * shared >= 3 * (len(pool) + len(other) - shared):
            a = jaccard.signatures(pool, common, bands)
            assert len(np.intersect1d(a, jaccard.signatures(other, common, bands)))
        apart = len(np.setxor1d(pool, other))
        if len(other):
            assert jaccard.fewest_differences(jaccard.sketch(pool), jaccard.sketch(other)) <= apart


def test_sets_of_one_size_share_their_bands(monkeypatch):
    """Bands are worked out in fractions: once for a size, not for each set."""
    rng = np.random.default_rng(11)
    bands, asked = jaccard.Bands(jaccard.Fraction(7, 9)), []
    plain = jaccard.Bands.targets

    def targets(self, size):
        asked.append(size)
        return plain(self, size)

    monkeypatch.setattr(jaccard.Bands, "targets", targets)
    none = np.array([], np.uint64)
    for _ in range(50):
        jaccard.signatures(np.unique(rng.integers(1, 1 << 63, 40).astype(np.uint64)), none, bands)
    assert asked == [40]


def test_pairs_are_compared_as_one_by_one():
    rng = np.random.default_rng(12)
    bands = jaccard.Bands(jaccard.Fraction(3, 4))
    pool = rng.integers(1, 1 << 63, 900).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, int(n))) for n in rng.integers(1, 900, 60)]
    bits = [jaccard.sketch(s) for s in sets]
    x, y = rng.integers(0, 60, (2, 300))
    got = jaccard.fewest_of_pairs([bits[k].tobytes() for k in x], [bits[k].tobytes() for k in y])
    assert got.tolist() == [jaccard.fewest_differences(bits[i], bits[j]) for i, j in zip(x, y, strict=True)]
    for i, j in zip(x, y, strict=True):
        apart = len(np.setxor1d(sets[i], sets[j]))
        assert jaccard.differing(sets[i].tobytes(), sets[j].tobytes()) == apart
        n, shared = len(sets[i]) + len(sets[j]), (len(sets[i]) + len(sets[j]) - apart) // 2
        assert bool(bands.linked(len(sets[i]), len(sets[j]), apart)) == (4 * shared >= 3 * (n - shared))


def test_rounds_try_each_pair_once():
    """What fails is left out, and what remains is a forest."""
    bands = jaccard.Bands(jaccard.Fraction(3, 4))
    elements = np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits = jaccard.sketch(elements).tobytes()
    rows = [(1, c, c, 199, bits, None) for c in range(6)]
    assert len(jaccard._across(rows, bands, 1)) == 4  # the first has been compared with all
    rows = [(1, c, c, 199, bits, [y for y in range(6) if y != c]) for c in range(6)]
    assert jaccard._across(rows, bands, 4) == []


def test_a_passage_does_not_sign_for_unrelated_sets():
    """A third to six sevenths of each set is one passage: no index of a set meets another set."""
    rng = np.random.default_rng(4)
    bands = jaccard.Bands(jaccard.Fraction(3, 4))
    for own, shared in ((200, 100), (150, 150), (80, 240), (60, 300)):
        passage = np.sort(rng.integers(1, 1 << 63, shared).astype(np.uint64))
        sets = [
            np.unique(np.concatenate([passage, rng.integers(1, 1 << 63, own).astype(np.uint64)]))
            for _ in range(20)
        ]
        counts = np.full(shared, 20)
        signed = [jaccard.roles(s, passage, counts, bands) for s in sets]
        for k, (a, probe) in enumerate(signed):
            for b, _ in signed[:k] + signed[k + 1 :]:
                assert not len(np.intersect1d(a[~probe], b))


def test_smaller_set_meets_larger_by_its_index():
    rng = np.random.default_rng(5)
    bands = jaccard.Bands(jaccard.Fraction(3, 4))
    passage = np.sort(rng.integers(1, 1 << 63, 300).astype(np.uint64))
    counts = rng.integers(5, 50, 300)
    found = 0
    for _ in range(2000):
        shared = rng.choice(passage, int(rng.integers(1, 300)), replace=False)
        shared = np.concatenate([shared, rng.integers(1, 1 << 63, int(rng.integers(0, 60))).astype(np.uint64)])
        a, b = (
            np.unique(np.concatenate([shared, rng.choice(passage, n), rng.integers(1, 1 << 63, n).astype(np.uint64)]))
            for n in rng.integers(0, 20, 2)
        )
        if bands.linked(len(a), len(b), len(np.setxor1d(a, b))):
            found += 1
            small, large = sorted((a, b), key=len)
            signed, probe = jaccard.roles(small, passage, counts, bands)
            assert len(np.intersect1d(signed[~probe], jaccard.roles(large, passage, counts, bands)[0]))
    assert found > 500


def test_large_signatures_are_dealt_in_tiles(spark):
    members = [(1, c, 20) for c in range(2000)] + [(2, c, 1) for c in range(3)]
    dealt = jaccard._dealt(spark.createDataFrame(members, "key long, c long, tiles long"))
    rows = dealt.collect()
    groups = defaultdict(set)
    for r in rows:
        groups[r["key"], r["i"], r["j"]].add(r["c"])
    assert max(map(len, groups.values())) < 300
    together = {(a, b) for g in groups.values() for a in list(g)[:40] for b in g}
    assert groups[2, 0, 0] == {0, 1, 2} and len(together) > 2000
    at = {r["c"]: r["at"] for r in rows if r["key"] == 1}
    assert all({a, b} <= groups[1, *sorted((at[a], at[b]))] for a in range(50) for b in range(50, 2000))
    texts = near_copies(random.Random(3), 200)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r["doc_id"], r["component_id"]) for r in jaccard.near_duplicates(docs, tile=3).collect()]
    want = brute.near_duplicates(list(range(len(texts))), texts)
    assert sorted(got) == [(k, w[1]) for k, w in enumerate(want)]


# Repeats -------------------------------------------------------------------------------------


def test_suffix_order_and_common_prefixes():
    rng = random.Random(2)
    for _ in range(400):
        depth = rng.choice([3, 8, 9, 17, 20])
        letters = rng.choice(["a", "ab", "abcdefgh"])
        base = "".join(rng.choice(letters) for _ in range(60))
        strings = []
        for _ in range(rng.randint(1, 6)):
            at = rng.randint(0, 40)
            strings.append(base[at : at + rng.randint(1, 40)].encode())
        data = np.frombuffer(b"".join(s + b"\xff" for s in strings), np.uint8)
        wanted, at = np.zeros(len(data), bool), 0
        for s in strings:
            wanted[at : at + max(0, len(s) - depth + 1)] = True
            at += len(s) + 1
        order = suffixes.suffix_order(data, wanted, depth)
        keys = [data[i : i + depth].tobytes() for i in order]
        assert sorted(order) == list(np.flatnonzero(wanted)) and keys == sorted(keys)
        alike = suffixes.common_prefixes(data, order, depth)
        for k in range(1, len(order)):
            n = next((i for i in range(depth) if keys[k][i] != keys[k - 1][i]), depth)
            assert alike[k] == n


def test_every_window_has_its_anchors(monkeypatch):
    rng = random.Random(9)
    data = bytes(rng.choice(b"abc") for _ in range(3000))
    whole = anchors.anchors(np.frombuffer(data, np.uint8), 8, 20)
    monkeypatch.setattr(anchors, "BLOCK", 64)
    places, hashes = anchors.anchors(np.frombuffer(data, np.uint8), 8, 20)
    assert (places == whole[0]).all() and (hashes == whole[1]).all()
    has = set(places.tolist())
    assert all(any(p in has for p in range(i, i + 13)) for i in range(len(data) - 19))


def test_repeats_are_removed_exactly(spark):
    rng = random.Random(5)
    texts = [None, "", "short", "aaaa" * 40, "ab" * 90, "é" * 60, "\x00" * 70]
    for _ in range(110):
        letters = rng.choice(["a", "ab", "xyz é"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 90)))
        if rng.random() < 0.5:
            other = rng.choice(texts) or ""
            at = rng.randint(0, len(other))
            text += other[at : at + rng.randint(0, 60)] + text[::-1]
        texts.append(text)
    rows = [(k or None, t, "x") for k, t in enumerate(texts)] + [(9, texts[9], "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, k string").repartition(4)
    options = dict(length=20, width=8, task_anchors=500)
    want = brute.repeats([r[1] for r in rows], 20)
    got = repeats.repeat_counts(docs, **options)
    assert by_id(map(tuple, got.collect())) == by_id(
        (r[0], *w) for r, w in zip(rows, want, strict=True)
    )
    assert 0 < sum(w[1] for w in want) < sum(w[0] for w in want)
    left = repeats.without_repeats(docs, **options)
    assert left.columns == docs.columns and left.count() == len(rows)
    assert repeats.repeat_counts(docs.limit(0), **options).count() == 0


def test_repeats_around_hot_anchors(spark):
    """A passage with other surroundings in each text, and some surroundings in a few."""
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh") for _ in range(45))
    ends = ["".join(rng.choice("xyz") for _ in range(14)) for _ in range(6)]
    texts = [passage[:19], passage * 2, passage]
    for _ in range(120):
        own = "".join(rng.choice("mnop") for _ in range(30))
        low, high = rng.choice([(0, 45), (0, 45), (3, 30), (20, 45)])
        texts.append(own + rng.choice(["", *ends]) + passage[low:high] + rng.choice(["", *ends]) + own[::-1])
    rows = [*enumerate(texts), (5, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute.repeats([r[1] for r in rows], 20)
    for hot_contexts in (0, 3, 20):
        got = repeats.repeat_counts(docs, length=20, width=8, hot_contexts=hot_contexts)
        assert by_id(map(tuple, got.collect())) == by_id(
            (r[0], *w) for r, w in zip(rows, want, strict=True)
        )


def test_repeats_of_long_passages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = brute.repeats([r["text"] for r in rows], 200)
    got = repeats.repeat_counts(docs).collect()
    assert by_id(map(tuple, got)) == by_id((r[0], *w) for r, w in zip(rows, want, strict=True))


# Embeddings ----------------------------------------------------------------------------------


def test_near_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(30, 8))
    rows = []
    for k in range(300):
        near = base[k % 30] + rng.normal(size=8) * rng.choice([0, 0.1, 0.5])
        rows.append((k, (near if k % 3 else rng.normal(size=8)).tolist(), "x"))
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [nan] * 8, [inf] * 8, [1.0] * 8]
    odd += [[2.0] * 8, [1.0, 2.0], [2.0, 4.0], [1e-300] * 8]
    rows += [(400 + k, v, "x") for k, v in enumerate(odd)]
    rows += [(None, [1.0] * 8, "x"), (5, rows[5][1], "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, k string")
    got = embeddings.near_vectors(vectors).collect()
    want = brute.near_vectors([r[0] for r in rows], [r[1] for r in rows])
    assert by_id((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == by_id(
        (r[0], *w) for r, w in zip(rows, want, strict=True)
    )
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)
    assert embeddings.near_vectors(vectors.limit(0)).count() == 0


def test_near_vectors_of_many_shards(spark):
    """Thousands of links over several shards, one cluster of a third of the rows."""
    rng = np.random.default_rng(7)
    blob = rng.normal(size=24)
    vectors = rng.normal(size=(900, 24))
    vectors[:300] = blob + rng.normal(size=(300, 24)) * rng.choice([0.05, 0.25, 0.4], (300, 1))
    for k in range(300, 700, 4):
        vectors[k + 1 : k + 4] = vectors[k] + rng.normal(size=(3, 24)) * 0.2
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = embeddings.near_vectors(data, shard_vectors=60).collect()
    want = brute.near_vectors([r[0] for r in rows], [r[1] for r in rows])
    assert sum(w[0] for w in want) > 10_000
    assert by_id((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == by_id(
        (r[0], *w) for r, w in zip(rows, want, strict=True)
    )


def test_a_shard_whose_graph_fails_answers_by_products(monkeypatch):
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(400, 16))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    unit[200:] = unit[:200]
    nothing = (np.full((1, 1), -1, np.int32), np.full((1, 1), -np.inf, np.float32))
    lost = lambda self, q, beam: tuple(np.repeat(x, len(q), axis=0) for x in nothing)
    monkeypatch.setattr(hnsw.Graph, "search", lost)
    shard = embeddings._Shard(list(range(400)), [1] * 400, unit, 0.9)
    assert shard.beam == 400
    got = {key: n for key, _, n in shard.links(list(range(400)), unit)}
    want = ((unit @ unit.T) >= 0.9).sum(axis=1) - 1
    assert got == {k: n for k, n in enumerate(want) if n}


def test_graph_finds_neighbours():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 24))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = hnsw.Graph(vectors, rng.random(3000))
    queries = vectors[:200]
    ids, near = graph.search(queries, 64)
    truth = np.argsort(-queries @ vectors.T, axis=1)[:, :10]
    met = sum(len(np.intersect1d(a, b)) for a, b in zip(ids, truth, strict=True))
    assert met >= 0.95 * truth.size
    assert (np.diff(near, axis=1) <= 0).all()
    assert (hnsw.Graph(vectors[:1], rng.random(1)).search(vectors[:3], 5)[0][:, 0] == 0).all()


# Pipeline ------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)

    def after(name, rows):
        out = stages[name](spark, rows, sf_dir)
        assert out.columns == docs.columns
        return out.cache()

    told = after(names[0], docs)
    assert 0.97 * docs.count() <= told.count() <= docs.count()

    kept = after(names[1], told)
    rows = told.select("doc_id", "text").collect()
    found = brute.near_duplicates([r[0] for r in rows], [r[1] for r in rows])
    assert {r[0] for r in kept.select("doc_id").collect()} == {component for _, component in found}

    left = after(names[2], kept)
    rows = kept.select("doc_id", "text").collect()
    gone = {r[0]: w[1] for r, w in zip(rows, brute.repeats([r[1] for r in rows], 200), strict=True)}
    sizes = {r["doc_id"]: len(r["text"].encode()) for r in rows}
    for r in left.collect():
        assert len(r["text"].encode()) <= sizes[r["doc_id"]] - gone[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])

    mixed = after(names[3], left)
    copies = mixed.groupBy("doc_id").count()
    assert copies.where("count > 3").count() == 0
    pieces = stages[names[4]](spark, mixed, sf_dir)
    ends = pieces.groupBy("doc_id").agg((F.sum("length") / F.first("doc_tokens")).alias("n"))
    assert copies.join(ends, "doc_id").where("count <> n").count() == 0
    assert ends.count() == copies.count()
    assert corpus_pipeline.run(spark, sf_dir).columns == pieces.columns
