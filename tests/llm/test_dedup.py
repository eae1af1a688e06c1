"""Substring, SimHash and embedding dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillsight.llm import components, embedding_dedup, simhash, substring_dedup
from tillsight.llm.common import forest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, n_words string"


def words(text):
    return WORD.findall(text or "")


def roots(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def corpus(seed, n=120):
    """Texts with copies, near copies, shared passages, inner repeats, odd white space and empties."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)] + ["é x", "a b", "Zz"]
    passage = " ".join(rng.choices(vocabulary, k=30))
    out = []
    for i in range(n):
        kind = rng.random()
        text = rng.choice([" ", "\n", "\t "]).join(rng.choices(vocabulary, k=rng.randint(0, 60)))
        if out and kind < 0.2:
            text = rng.choice(out)[1] or ""
        elif out and kind < 0.35:
            old = (rng.choice(out)[1] or "").split(" ")
            old[rng.randrange(len(old))] = "changed"
            text = " ".join(old)
        elif kind < 0.55:
            text = text[: len(text) // 2] + " " + passage + "\r\n" + text[len(text) // 2 :]
        elif kind < 0.6:
            text = " ".join(rng.choices(["x", "y"], k=1) * rng.randint(15, 90))
        elif kind < 0.63:
            text = rng.choice(["", None, "  \n", "one", "one two"])
        out.append((i * 3 % (3 * n + 1), text))
    return out


def removed_by_hand(rows, window):
    seen, out = set(), {}
    for i, text in sorted(rows):
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if key in seen:
                gone[k : k + window] = [True] * window
            seen.add(key)
        out[i] = (len(w), sum(gone), [x for x, g in zip(w, gone) if not g])
    return out


@pytest.mark.parametrize("seed,block,least", [(1, 6_000_000, 256), (2, 300, 256), (3, 50, 1024)])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, seed, block, least):
    monkeypatch.setattr(substring_dedup, "BLOCK_CHARS", block)
    monkeypatch.setattr(substring_dedup, "LEAST_RANGES", least)
    rows = corpus(seed)
    expected = removed_by_hand([(i, t or "") for i, t in rows], 20)
    df = spark.createDataFrame([(i, t, "en", "x") for i, t in rows], DOCS).repartition(5)
    got = substring_dedup.remove_repeats(df)
    assert got.columns == ["doc_id", "text", "lang", "n_words", "n_removed"]
    before = dict(rows)
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        n, gone, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed, words(r.text)) == (n, gone, kept)
        if not gone:
            assert r.text == before[r.doc_id]
    assert sum(e[1] for e in expected.values()) > 500


def test_substring_dedup_odd_tables(spark):
    long = " ".join("k%d" % (i % 7001) for i in range(20000))
    rows = [(None, "a " * 40), (1, "a " * 40), (1, "b"), (1, "b"), (2, long), (3, None)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    by = sorted(((r.doc_id or -1, r.n_words, r.n_removed) for r in got.collect()))
    # the row without id comes first: its own repeats go, and all of the next copy
    assert by == [(-1, 40, 39), (1, 1, 0), (1, 1, 0), (1, 40, 40), (2, 20000, 20000 - 7001), (3, 0, 0)]
    assert substring_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_substring_dedup_of_rows_without_id(spark, monkeypatch):
    """A third of the rows has no id, many of them one text: they are spread over the blocks, and of equal
    passages one stays."""
    monkeypatch.setattr(substring_dedup, "BLOCK_CHARS", 400)
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(40)]
    shared = " ".join(f"s{i}" for i in range(25))
    rows = [(None, texts[0])] * 60 + [(None, t) for t in texts[1:20]] + [(None, f"n{i} {shared} m{i}") for i in range(30)]
    rows += [(i, t) for i, t in enumerate(texts)] + [(100, shared)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = substring_dedup.remove_repeats(df).collect()
    assert len(got) == len(rows)
    copies = [r for r in got if r.doc_id is None and r.n_words == 30]
    assert sorted(r.n_removed for r in copies) == [0] * 20 + [30] * 59
    passages = [r for r in got if r.doc_id is None and r.n_words == 27]
    assert sorted(r.n_removed for r in passages) == [0] + [25] * 29
    named = {r.doc_id: r.n_removed for r in got if r.doc_id is not None}
    assert named == {**{i: 30 if i < 20 else 0 for i in range(40)}, 100: 25}


def test_windows_with_one_equal_hash_are_told_apart():
    hashes, more = np.array([5, 7, 5, 5, 7], np.uint64), np.array([1, 1, 2, 1, 1], np.uint16)
    by, begin = substring_dedup.runs(hashes, more)
    groups = [by[a:b].tolist() for a, b in zip(begin, [*begin[1:], len(by)])]
    assert sorted(groups) == [[0, 3], [1, 4], [2]]
    by, begin = substring_dedup.runs(hashes[:0], more[:0])
    assert len(by) == len(begin) == 0


def test_cut_keeps_white_space_between_kept_words():
    text = b" a  b\nc d\te "
    assert substring_dedup.cut(text, np.array([0, 0, 1, 0, 0], bool)) == b"a  b d\te"
    assert substring_dedup.cut(text, np.ones(5, bool)) == b""


def fingerprint_by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return 0
    parts = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_equals_brute_force(spark):
    rows = corpus(5, 200)
    marks = {i: fingerprint_by_hand(t) for i, t in rows}
    ids = sorted(marks)
    links = [(a, b) for a in ids for b in ids if a < b and (marks[a] ^ marks[b]).bit_count() <= 3]
    expected = roots(ids, links)
    df = spark.createDataFrame([(i, t, "en", "x") for i, t in rows], DOCS)
    got = simhash.near_duplicates(df).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (format(marks[i], "016x"), expected[i]) for i in ids
    }
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


@pytest.mark.parametrize("tile", [4096, 3])
def test_near_links_lose_no_link(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "HELD_LINKS", 5)
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    marks = set(base.tolist()) | {0, 1, 2**63 - 1}
    for m in base.tolist()[:20]:
        for _ in range(12):
            flips = rng.choice(63, rng.integers(1, 6), replace=False)
            marks.add(m ^ int(sum(1 << int(b) for b in flips)))
    marks = sorted(marks)
    links = [(a, b) for a in marks for b in marks if a < b and (a ^ b).bit_count() <= 3]
    table = spark.createDataFrame([(m,) for m in marks], "mark long").repartition(3)
    found = [(r.a, r.b) for r in simhash.near_links(table, 3, tile).collect()]
    assert all((a ^ b).bit_count() <= 3 * 64 for a, b in found)
    assert roots(marks, found) == roots(marks, links)


def test_manhattan_of_segment_counts_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 64, (2, 3000), dtype=np.uint64)
    counts = [[(int(x) >> 2 * i & 3).bit_count() for i in range(32)] for x in a]
    others = [[(int(x) >> 2 * i & 3).bit_count() for i in range(32)] for x in b]
    by_hand = [sum(abs(p - q) for p, q in zip(x, y)) for x, y in zip(counts, others)]
    got = simhash.manhattan(simhash.segment_counts(a), simhash.segment_counts(b))
    assert got.tolist() == by_hand
    assert (got <= np.bitwise_count(a ^ b)).all()


def test_simhash_odd_tables(spark):
    rows = [(7, ""), (5, None), (9, "a b c d"), (9, "a b c d"), (None, "a b c d"), (4, "   ")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in got) == [
        (-1, 9), (4, 4), (5, 4), (7, 4), (9, 9), (9, 9),
    ]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [4, 9]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_first(empty).count() == 0
    alone = spark.createDataFrame([(None, "q w e r"), (3, "t")], "doc_id long, text string")
    assert simhash.keep_first(alone).count() == 2


def test_keep_first_keeps_a_row_of_every_group(spark):
    def text(k, n=40):
        return " ".join(f"g{k}x{i}" for i in range(n))

    rows = [
        (None, text(1), "a"), (None, text(2), "b"), (None, text(2), "c"), (None, text(3), "d"),
        (1, text(4), "e"), (5, text(4), "f"), (5, text(5), "g"), (7, text(6), "h"), (7, text(7), "i"),
        (8, text(3), "j"), (9, None, "k"), (None, "", "l"), (7, text(6), "h"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.source for r in kept.collect()) == ["a", "b", "e", "g", "h", "i", "j", "k"]


def test_components_of_chains_stars_and_noise(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)]
    links += [(5000, 5000), (None, 3), (1, None), (7000, 6999), (7000, 6999)]
    random.Random(0).shuffle(links)
    got = components.components(spark.createDataFrame(links, "a long, b long").repartition(4))
    by = {r.node: r.root for r in got.collect()}
    assert by == {**{i: 0 for i in range(1, 301)}, **{i: 1000 for i in range(1001, 1200)}, 7000: 6999}


def test_forest_spans_each_component():
    a, b = forest(np.array([5, 6, 9, 5]), np.array([6, 7, 8, 7]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(6, 5), (7, 5), (9, 8)]


def vectors(seed, n=260, dim=16):
    rng = np.random.default_rng(seed)
    rows, base = [], rng.normal(size=(30, dim))
    for i in range(n):
        v = base[rng.integers(30)] + rng.normal(size=dim) * rng.choice([0.02, 0.25, 0.4])
        v = (v * rng.choice([1.0, 3.5])).astype(np.float32).tolist()
        rows.append((int(i), v, int(rng.integers(2))))
    for i in range(40):
        old = rows[int(rng.integers(20))]
        rows.append((n + i, old[1], old[2]))
    odd = [None, [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1),
           [float("inf")] * dim, [], [1.0]]
    rows += [(n + 40 + i, v, 0) for i, v in enumerate(odd)]
    return rows + [(n + 60, rows[0][1], None)]


def links_by_hand(rows):
    good = [
        (i, np.array(v, float), l) for i, v, l in rows
        if v and l is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    return [
        (a[0], b[0]) for k, a in enumerate(good) for b in good[k + 1 :]
        if a[2] == b[2] and len(a[1]) == len(b[1])
        and np.dot(a[1], b[1]) / (np.linalg.norm(a[1]) * np.linalg.norm(b[1])) >= 0.93
    ]


@pytest.mark.parametrize("seed,cell,tile", [(1, 4096, 2048), (2, 20, 7), (3, 8, 64)])
def test_embedding_dedup_equals_brute_force(spark, seed, cell, tile):
    rows = vectors(seed)
    links = links_by_hand(rows)
    ids = [r[0] for r in rows]
    expected, n = roots(ids, links), {i: 0 for i in ids}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = embedding_dedup.near_duplicates(df.withColumn("n", F.lit("x")), cell=cell, tile=tile)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()} == {
        i: (n[i], expected[i], expected[i] == i) for i in ids
    }
    assert len(links) > 400


def test_embedding_dedup_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (None, [1.0, 0.0], 1)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in got) == [
        (-1, 3, 2, False), (2, 3, 2, True), (4, 3, 2, False), (4, 3, 2, False),
    ]


def test_queries_give_digests_of_kept_words(spark, tmp_path):
    from tillsight.llm import queries

    rows = corpus(9, 60)
    spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    expected = removed_by_hand([(i, t or "") for i, t in rows], 20)
    for r in queries.op6_substring_dedup(spark, str(tmp_path)).collect():
        n, gone, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed) == (n, gone)
        assert r.kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_embedding_dedup_of_very_large_and_small_vectors(spark):
    """Cosines do not depend on the size of the components."""
    schema = "vec_id long, embedding array<double>, label int"
    shapes = [[3.0, 4.0, 0.0], [3.0, 4.0, 0.5], [0.0, 0.0, 1.0], [-3.0, -4.0, 0.1]]
    rows = [(10 * i + j, [x * s for x in v], 1) for i, v in enumerate(shapes) for j, s in enumerate((1e200, 1.0, 1e-300, 5e-324))]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()}
    for i, v in enumerate(shapes):
        for j in range(3):
            others = sum(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93 for w in shapes) * 3 - 1
            # the least numbers lose their digits: 3, 4 and 0 stay apart, fractions go
            tiny = [np.array([x * 5e-324 for x in w]) / 5e-324 for w in shapes]
            others += sum(bool(np.any(t)) and np.dot(v, t) / np.linalg.norm(v) / np.linalg.norm(t) >= 0.93 for t in tiny)
            assert got[10 * i + j].n_links == others


def test_embedding_visits_are_sent_in_small_parts(monkeypatch):
    """10,000 vectors of 256 components against 64 cells: no batch holds more than its bound, whatever the
    vectors visit, and the visits are those of one go."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    centroids = rng.normal(size=(64, 256))
    centroids /= np.linalg.norm(centroids, axis=1, keepdims=True)
    x = rng.normal(size=(10_000, 256))
    cells = np.argmax((x / np.linalg.norm(x, axis=1, keepdims=True)) @ centroids.T, axis=1).astype(np.int32)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.full(10_000, 7)), pa.array(np.arange(10_000)), pa.array(np.ones(10_000, np.int64)),
         pa.array([v.tobytes() for v in x], pa.binary()), pa.array(cells), pa.array(np.ones(10_000))],
        ["group", "rep", "n", "vec", "cell", "cosine"],
    )
    widest = {(7, k): 3.0 for k in range(64)}
    made = homes = visits = 0
    for out in embedding_dedup._visits({7: centroids}, widest, 0.5)([batch]):
        assert out.num_rows <= embedding_dedup.SENT
        made += 1
        count = int(np.sum(out.column("home").to_numpy(zero_copy_only=False)))
        homes, visits = homes + count, visits + out.num_rows - count
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    apart = embedding_dedup._apart(centroids, cells)
    all_at_once = embedding_dedup.visited(unit @ centroids.T, cells, apart, np.full(64, 3.0), 0.5)
    assert (homes, visits) == (10_000, int(all_at_once.sum())) and visits > 50_000 and made > 20
