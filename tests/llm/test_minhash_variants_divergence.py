"""MinHash groups, spelling variants and source divergence against brute force, on given rows and on edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from risewatch.llm import divergence, minhash, variants

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(params=["given", "edge", "empty"])
def some(request, docs, edge, empty):
    return {"given": docs, "edge": edge, "empty": empty}[request.param]


# --- MinHash ------------------------------------------------------------------


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_groups(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    shared = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            shared[x].append(i)
    both = Counter((a, b) for found in shared.values() for n, a in enumerate(found) for b in found[n + 1 :])
    for (a, b), n in both.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n) and find(a) != find(b):
            up[find(b)] = find(a)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return Counter((doc, len(s), least.get(find(i)), doc == least.get(find(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True)))


def test_minhash_groups(some):
    rows = [(r["doc_id"], r["text"]) for r in some.select("doc_id", "text").collect()]
    assert Counter(map(tuple, minhash.near_groups(some).collect())) == brute_groups(rows)


def test_links_beside_the_pivot(spark, monkeypatch):
    """Copies of copies, most of them too far from any one member of their bucket, compared in blocks of a few members."""
    monkeypatch.setattr(minhash, "CHUNK", 3)
    draw = random.Random(5)
    rows = []
    for group in range(6):
        text = [f"g{group}w{i}" for i in range(150)]
        for copy in range(30):
            if copy % 3 == 0:  # walks on; the others stay beside
                for i in draw.sample(range(150), 2 + group):
                    text[i] = f"n{draw.random()}"
            beside = list(text)
            for i in draw.sample(range(150), copy % 3):
                beside[i] = f"m{draw.random()}"
            rows.append((len(rows) * 7 % 181, " ".join(beside)))
    some = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_groups(rows)
    assert Counter(map(tuple, minhash.near_groups(some).collect())) == want
    # without any link from a pivot the blocks alone find all components
    texts = dict(rows)
    sets = {i: minhash.shingle_set(t) for i, t in texts.items()}
    nodes = spark.createDataFrame([(i, bytearray(minhash.signature(x).tobytes())) for i, x in sets.items()], "node long, signature binary")
    hashes = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in sets.items()], "node long, hashes binary")
    spread = minhash.settle(minhash.map_batches(nodes, minhash._band_batch, "node long, band int, bucket long"))
    none = spark.createDataFrame([], "node long, root long")
    links = minhash.crossing(spread, nodes, hashes, none).collect()
    assert links and all(a != b for a, b in links)
    roots = {r["node"]: r["root"] for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {i: roots.get(i, i) for i in texts} == {doc: c for doc, _, c, _ in want}


def test_a_block_gives_out_a_forest():
    """Near copies that are all linked to each other, each a component of its own: one link fewer than members."""
    base = [f"w{i}" for i in range(400)]
    rows = []
    for n in range(20):
        text = minhash.shingle_set(" ".join([*base[:n], f"x{n}", *base[n + 1 :]]))
        rows.append((n, n, 1 if n else 0, 0, minhash.signature(text).tobytes(), text.tobytes()))
    rows += [(*row[:2], 2, *row[3:]) for row in rows[1:]]
    band = [x for x in range(minhash.BANDS)]
    links = {pair for b in band for pair in minhash._links([(*r[:3], b, *r[4:]) for r in rows])}
    up = {n: n for n in range(20)}
    for a, b in links:
        up = {n: (up[a] if r == up[b] else r) for n, r in up.items()}
    assert len(set(up.values())) == 1
    assert all(len(list(minhash._links([(*r[:3], b, *r[4:]) for r in rows]))) < 20 for b in band)


# --- spelling variants --------------------------------------------------------


def brute_vocabulary(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def brute_near(words):
    """Words that share one with a code point deleted, confirmed."""
    met = defaultdict(set)
    for w in words:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            met[x].add(w)
    out = defaultdict(set)
    for found in met.values():
        for a in found:
            for b in found:
                short, long = sorted((a, b), key=len)
                same = len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1
                if same or len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long))):
                    out[a].add(b)
    return out


def test_variants(some):
    rows = [(r["doc_id"], r["text"]) for r in some.select("doc_id", "text").collect()]
    count = brute_vocabulary(rows)
    near = brute_near(count)
    form = {}
    for w, n in count.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-count[x], x))
            if count[best] >= 2 * n:
                form[w] = best
    want = set()
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        want.add((w, form.get(w), root, n, len(near[w]), count.get(form.get(w))))
    got = variants.variants(some)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = list(map(tuple, got.collect()))
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_near_words_of_any_alphabet(spark, most):
    """Few letters, so that ranges are large and are cut to their last place."""
    draw = random.Random(most)
    words = sorted({"".join(draw.choices("abÿ", k=draw.randint(5, 8))) for _ in range(400)} | {"aaaaaa" + "b" * i for i in range(12)})
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    got = [(r["word"], r["other"], words[r["n"]]) for r in variants.near_words(df, most).collect()]
    near = brute_near(words)
    assert len(got) == len(set(got)) and set(got) == {(a, b, b) for a in words for b in near[a]}


def test_scan_of_a_sorted_list():
    draw = random.Random(3)
    for size in range(1, 60):
        words = sorted({"".join(draw.choices("abc", k=draw.randint(0, 6))) for _ in range(size)})
        near = brute_near(words)
        want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i < j and b in near[a]}
        assert sorted(variants.scan(words)) == sorted(want)


def test_roots_of_a_chain(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w5"), ("y", "w13")]
    got = variants.roots(spark.createDataFrame(links, "word string, form string")).collect()
    assert {r["word"]: r["root"] for r in got} == {a: "w13" for a, _ in links} and len(got) == len(links)


# --- source divergence --------------------------------------------------------


def brute_audit(rows, min_docs, top=10):
    """Rows: (text, lang, source)."""
    times, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        times[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in {k for k, _ in times}:
        kept = {t for t, n in docs[lang].items() if n >= min_docs}
        sources = [s for k, s in times if k == lang]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(times[lang, s]) for s in sources}
        q = shares(sum((times[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if times[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, n + 1) for n, (item, value) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("min_docs", [1, 10])
def test_audit(some, min_docs, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 50)
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", 3)
    rows = [(r["text"], r["lang"], r["source"]) for r in some.select("text", "lang", "source").collect()]
    got = list(map(tuple, divergence.audit(some, min_docs=min_docs).collect()))
    assert len(got) == len(set(got)) and set(got) == brute_audit(rows, min_docs)


def test_skyband_holds_the_first_of_any_ranking(spark):
    import pyarrow as pa

    draw = random.Random(2)
    rows = [(draw.randint(1, 12), draw.randint(0, 9), "".join(draw.choices("abé", k=6))) for _ in range(600)]
    rows = [(n, n + more, t) for n, more, t in {t: (n, m, t) for n, m, t in rows}.values()]
    table = pa.table({"n": [r[0] for r in rows], "lang_n": [r[1] for r in rows], "term": [r[2] for r in rows]})
    for k in (1, 4):
        dominated = {r: sum(x != r and x[0] >= r[0] and x[1] <= r[1] and x[2].encode() < r[2].encode() for x in rows) for r in rows}
        got = divergence.skyband(table, k).to_pylist()
        assert {(r["n"], r["lang_n"], r["term"]) for r in got} == {r for r, n in dominated.items() if n < k}


def test_counts_beyond_a_long(spark):
    """The product in a share has up to 31 digits."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(7 * 10**12, 9 * 10**12, 10**6)], "n long, total long, v long")
    got = df.select(divergence.share(F.col("n"), F.col("total"), F.col("v")).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (7 * 10**12 + 2) // (9 * 10**12 + 2 * 10**6)
