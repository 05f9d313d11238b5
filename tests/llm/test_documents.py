"""Operators on documents against brute force, on given rows and on edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from risewatch.llm import exact, mixing, repeats, sharding, simhash
from risewatch.llm.shared import components

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(params=["given", "edge"])
def some(request, docs, edge):
    return docs if request.param == "given" else edge


def read(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]


# --- exact copies -------------------------------------------------------------


def test_exact_groups(some):
    rows = read(some)
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i is None, i or 0, i))
    want = Counter()
    for k, members in groups.items():
        keep = min(members)[3]
        for n, m in enumerate(sorted(members)):
            want[m[3], keep, len(members), n == 0, hashlib.sha256(k.encode()).hexdigest()] += 1
    got = exact.exact_groups(some).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert Counter(map(tuple, got)) == want


def test_exact_deduplicated_keeps_one_row_each(edge):
    kept = exact.exact_deduplicated(edge)
    assert kept.columns == edge.columns
    texts = [SPACE.sub("", r["text"] or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({SPACE.sub("", t or "") for _, t, _ in read(edge)})


def test_fingerprints_combine():
    rng = np.random.default_rng(0)
    for n in (0, 1, 4095, 4096, 4097, 20_000):
        data = rng.integers(0, 256, n, np.uint8).tobytes()
        want = tuple(int.from_bytes(b"", "big") for _ in range(2))
        want = (0, 0)
        for byte in data:
            want = tuple((h * r + byte) % int(p) for h, r, p in zip(want, exact.BASES, exact.PRIMES, strict=True))
        assert exact.fingerprint(data) == want
        cut = n // 3
        assert exact.combine(exact.fingerprint(data[:cut]), exact.fingerprint(data[cut:]), n - cut) == want


def test_a_collision_of_fingerprints_joins_nothing(spark, edge, monkeypatch):
    """With every fingerprint alike, the comparison alone tells texts of equal length apart."""
    rows = exact.with_row(edge.select("doc_id", "text"))
    prints = exact._print_batch

    def blind(batch):
        out = prints(batch)
        return out.set_column(4, "print", [0] * out.num_rows)

    want = sorted(map(str, exact.exact_groups(edge).drop("row", "keep_row").collect()))
    monkeypatch.setattr(exact, "_print_batch", blind)
    assert rows.count() == edge.count()
    assert sorted(map(str, exact.exact_groups(edge).drop("row", "keep_row").collect())) == want


@pytest.mark.parametrize("sizes", [(40, 16), (0, 7), (300, 1000)])
def test_dealt_pieces_change_nothing(some, sizes):
    """Texts above a size are cut into rows that all tasks hash and compare; the result is the same."""
    want = sorted(map(str, exact.exact_groups(some).drop("row", "keep_row").collect()))
    got = exact.exact_groups(some, dealt_from=sizes[0], piece=sizes[1])
    assert sorted(map(str, got.drop("row", "keep_row").collect())) == want


def test_a_collision_of_long_texts_joins_nothing(edge, monkeypatch):
    want = sorted(map(str, exact.exact_groups(edge).drop("row", "keep_row").collect()))
    sums = exact._long_prints
    monkeypatch.setattr(exact, "_long_prints", lambda heads, pieces: sums(heads, pieces).withColumn("print", F.lit(0).cast("long")))
    got = exact.exact_groups(edge, dealt_from=0, piece=5)
    assert sorted(map(str, got.drop("row", "keep_row").collect())) == want


# --- mixing -------------------------------------------------------------------


def shares(sizes):
    """Targets by repeated resharing, as the contract says it."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s] + 1e-9]
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else left * weight[s] / total for s in names}
        capped |= set(over)


def test_mix(some):
    rows = read(some)
    size = Counter((i, len(WORD.findall(t or "")), s) for i, t, s in rows)
    got = mixing.mix(some).collect()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == size
    sums = defaultdict(int)
    for (_, n, s), k in size.items():
        sums[s] += n * k
    want, taken, largest = shares(sums), defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == sums[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    alike = defaultdict(int)  # equal ids are taken together
    for (i, n, s), k in size.items():
        alike[s, i] += n * k
    for (s, _), n in alike.items():
        largest[s] = max(largest[s], n)
    for s in sums:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = mixing.mix(some.repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_rows_with_one_id_are_split(spark):
    """A third of all rows without an id: the mix still meets its targets, and no bucket takes them all."""
    rows = [(None if i % 3 == 0 else i, f"some words of text {i}", "ab"[i % 2]) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    taken = mixing.mix(frame).groupBy("source", "target").agg(F.sum("taken").alias("n")).collect()
    assert all(abs(r["n"] - r["target"]) <= 5 for r in taken) and len(taken) == 2
    shards = sharding.shuffle_shards(frame, 10, bucket_bytes=8_000).where("doc_id is null").groupBy("shard").count().collect()
    assert len(shards) == 10 and max(r["count"] for r in shards) < 200


def test_mixed_rows_are_the_mix(edge):
    want = Counter()
    for r in mixing.mix(edge).collect():
        want[r["doc_id"], r["source"]] += r["copies"]
    mixed = mixing.mixed(edge)
    assert mixed.columns == edge.columns
    assert Counter((r["doc_id"], r["source"]) for r in mixed.collect()) == +want


def test_targets_of_many_sizes(spark):
    rng = np.random.default_rng(3)
    for k in (1, 2, 5, 40):
        sizes = {f"s{i:03d}": int(rng.integers(0, 10 ** int(rng.integers(1, 7)))) for i in range(k)} | {None: 17}
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = shares(sizes)
        for r in got:
            assert r["target"] == pytest.approx(want[r["source"]])


# --- sharding -----------------------------------------------------------------


def test_shards(some):
    n, rows = 40, Counter((i, zlib.crc32((t or "").encode())) for i, t, _ in read(some))
    out = sharding.shuffle_shards(some, n, bucket_bytes=5_000)
    got = out.select("doc_id", F.crc32(F.coalesce("text", F.lit(""))).alias("c"), "shard", "slot").collect()
    assert Counter((r["doc_id"], r["c"]) for r in got) == rows
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[k]) for k in range(n)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(n))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    again = sharding.shuffle_shards(some.repartition(7), n, bucket_bytes=5_000).select("doc_id", F.crc32(F.coalesce("text", F.lit(""))).alias("c"), "shard", "slot")
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got))


def test_written_shards_hold_their_rows(docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), 7)
    back = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 7
    assert back.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).count() == 0


def test_fisher_yates_is_uniform_and_seeded():
    assert list(sharding.fisher_yates(50, 1, 2)) == list(sharding.fisher_yates(50, 1, 2)) != list(sharding.fisher_yates(50, 1, 3))
    seen = Counter(tuple(sharding.fisher_yates(3, 7, b)) for b in range(6000))
    assert len(seen) == 6 and max(seen.values()) < 1.2 * min(seen.values())


# --- SimHash ------------------------------------------------------------------


def slow_simhash(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    values = np.array(prints, np.uint64)
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3).tolist():
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def test_simhash_groups(some):
    rows = [(i, slow_simhash(t)) for i, t, _ in read(some)]
    names = defaultdict(list)
    of = classes([p for _, p in rows])
    for (i, _), c in zip(rows, of, strict=True):
        names[c].append(i)
    least = {c: min((x for x in ids if x is not None), default=None) for c, ids in names.items()}
    want = Counter((i, p, least[c]) for (i, p), c in zip(rows, of, strict=True))
    got = simhash.near_groups(some).collect()
    assert Counter((r["doc_id"], r["print"] % (1 << 64), r["component_id"]) for r in got) == want


def test_near_links_find_every_pair(spark):
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 63, 60, np.uint64) * np.uint64(2)
    for _ in range(500):  # chains and clusters of all distances
        flips = rng.choice(64, rng.integers(0, 6), replace=False)
        values = np.append(values, values[rng.integers(len(values))] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64), initial=np.uint64(0)))
    values = np.unique(values)
    nodes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "print long")
    roots = {r["node"]: r["root"] for r in components(simhash.near_links(nodes)).collect()}
    got = [roots.get(int(v), int(v)) for v in values.view(np.int64)]
    want = classes(values)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(200)] + [(int(a), int(b)) for a, b in rng.integers(2000, 2400, (250, 2))]
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(links, "a long, b long").repartition(16)
    got = {r["node"]: r["root"] for r in components(frame).collect()}
    assert got == {x: root(x) for pair in links for x in pair if root(x) != x}
    assert components(frame.where("false")).count() == 0


def test_near_deduplicated(edge):
    kept = simhash.near_deduplicated(edge)
    assert kept.columns == edge.columns
    assert kept.count() == simhash.near_groups(edge).select("keep_row").distinct().count()


# --- repeated passages --------------------------------------------------------


def slow_repeats(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def test_repeats(some):
    some = some.where("text is null or length(text) < 50000")  # the brute force keeps every 200-byte string
    rows = read(some)
    want = Counter(zip([i for i, _, _ in rows], slow_repeats([t for _, t, _ in rows]), strict=True))
    got = repeats.without_repeats(some).collect()
    assert Counter((r["doc_id"], tuple(r)[1:]) for r in got) == want


def test_repeats_in_random_texts(spark, monkeypatch):
    rng = np.random.default_rng(11)
    pool = ["".join(rng.choice(list(a), n)) for a, n in (("ab", 700), ("a", 500), ("abcdefgh", 800), ("aé漢", 400))]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.integers(0, 5)):
            p = pool[rng.integers(4)]
            i, j = sorted(rng.integers(0, len(p), 2))
            parts.append(p[i:j])
        texts.append("".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.without_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == slow_repeats(texts)
    monkeypatch.setattr(repeats, "SEGMENT", 300)  # long texts in pieces have the same anchors for each window
    data = list(enumerate(t.encode() for t in texts))

    def owners():
        found = [x for part in repeats.anchors(iter(data)) for x in zip(*map(np.ndarray.tolist, part[:5]), strict=True)]
        return {(row, at - back): (at, name) for row, at, most, fewest, name in found for back in range(fewest, most + 1)}, len(found)

    pieces, _ = owners()
    monkeypatch.setattr(repeats, "SEGMENT", 1 << 20)
    wholes, _ = owners()
    assert pieces == wholes and len(wholes) == sum(max(0, len(b) - 199) for _, b in data)


def test_empty_tables(empty):
    assert exact.exact_groups(empty).count() == 0
    assert exact.exact_deduplicated(empty).count() == 0
    assert mixing.mix(empty).count() == mixing.mixed(empty).count() == 0
    assert sharding.shuffle_shards(empty, 40).count() == 0
    assert simhash.near_groups(empty).count() == simhash.near_deduplicated(empty).count() == 0
    assert repeats.without_repeats(empty).count() == 0
