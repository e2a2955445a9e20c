"""Search, SimHash components and tokenizer alignment against brute force, and on odd rows."""

import collections
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchbook.llm import alignment, lexical_search, simhash

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(0x41, 0x5B)})


@pytest.fixture(scope="module")
def table(spark, docs):
    """The odd rows of ``docs`` and a whole given table."""
    real = spark.read.parquet(f"{SMALL}/documents.parquet").select(F.col("doc_id") + 1000, "text")
    return docs.select("doc_id", "text").unionByName(real.toDF("doc_id", "text")).repartition(4).cache()


@pytest.fixture(scope="module")
def rows(table):
    return [tuple(r) for r in table.collect()]


# ---- search -------------------------------------------------------------------------------------

def ranking(rows, items, k):
    found = [(i, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in rows]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n_docs, n_terms = len(found), sum(n for *_, n in found)
    df = collections.Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        asked, scores = collections.Counter(TERM.findall((text or "").translate(LOWER))), []
        for i, c, n in found:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(
                reps * int(np.floor(1000 * np.log((2.0 * n_docs + 2) / (2 * df[t] + 1)))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, reps in asked.items() if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return out


@pytest.fixture(scope="module")
def items(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()][:12]
    odd = [None, "", "!!", "nowhere-to-be-found qqqqzz", "word3x3 WORD3X3 changed long long é 10", texts[0]]
    found = [(i, t) for i, t in enumerate(texts + odd)] + [(None, "id"), (1, texts[1])]
    return spark.createDataFrame([(*x, "en", 1) for x in found], "item_id bigint, text string, term string, rank int").repartition(3), found


def same(found, want):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted((tuple(r) for r in found), key=key) == sorted(want, key=key)


def test_search_is_brute_force(table, rows, items):
    frame, plain = items
    found = lexical_search.lexical_search(table, frame)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert same(found.collect(), ranking(rows, plain, 20))


def test_search_in_small_blocks_and_groups(table, rows, items, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK", 300)
    monkeypatch.setattr(lexical_search, "FIRST", 1)
    index = lexical_search.build_index(table)
    assert index.table.filter("block > 0").count() > 0
    assert index.table.filter("term is null").select(F.explode("ids")).count() == index.n_docs
    found = lexical_search.search(index, items[0], 3, group_terms=40, group_bounds=50)
    assert same(found.collect(), ranking(rows, items[1], 3))


def test_search_ties_and_repeats(spark):
    docs = spark.createDataFrame([(i, "alpha beta") for i in [5, None, 3, 3, 1]] + [(9, "gamma")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "beta BETA beta"), (2, "zeta")], "item_id int, text string")
    found = lexical_search.lexical_search(docs, items, 4).orderBy("rank").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in found] == [(1, 1, 1), (1, 2, 3), (1, 3, 3), (1, 4, 5)]


def test_search_empty(docs, empty, items):
    assert lexical_search.lexical_search(empty, items[0]).count() == 0
    assert lexical_search.lexical_search(docs, items[0].limit(0)).count() == 0


# ---- SimHash ------------------------------------------------------------------------------------

def components(fps, radius=4):
    values = np.array(sorted(set(fps)), np.uint64)
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= radius):
            root[find(int(j))] = find(i)
    return {int(v): find(i) for i, v in enumerate(values)}


def plain_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("crowd", [simhash.CROWD, 1])
def test_simhash_is_brute_force(table, rows, crowd):
    fps = [plain_fingerprint(t) for _, t in rows]
    group = components(fps)
    least = {}
    for (i, _), fp in zip(rows, fps, strict=True):
        if i is not None:
            least[group[fp]] = min(i, least.get(group[fp], i))
    want = [(i, f"{fp:016x}", least.get(group[fp])) for (i, _), fp in zip(rows, fps, strict=True)]
    found = simhash.simhash_dedup(table, crowd)
    assert same(found.select("doc_id", "fingerprint", "component_id").collect(), want)


def test_simhash_links_of_any_split_of_four_bits(spark):
    """Chains and stars of fingerprints up to 4 bits apart, near misses at 5; pair by pair and by midpoints."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64) * np.uint64(2)
    fps = set(base.tolist())
    for v in base.tolist():
        for bits in (1, 2, 3, 4, 4, 4, 5, 5, 6):
            flip = sum(1 << int(b) for b in rng.choice(64, bits, replace=False))
            fps |= {v ^ flip, v ^ flip ^ sum(1 << int(b) for b in rng.choice(64, 4, replace=False))}
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp bigint").repartition(4)
    want = components(fps)
    for crowd in (simhash.CROWD, 3, 0):
        links = [(r.a, r.b) for r in simhash.linked(frame, crowd=crowd).collect()]
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 or want[a % 2**64] == want[b % 2**64] for a, b in links)
        root = {x % 2**64: x % 2**64 for x in signed}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            root[find(a % 2**64)] = find(b % 2**64)
        assert len({find(x) for x in root}) == len(set(want.values()))


def test_forest_keeps_components_and_bounds_degree():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 400, (2, 300))
    for x, y in ((a, b), (np.zeros(5000, np.int64), np.arange(1, 5001)), (a[:0], b[:0])):
        u, v = simhash.forest(x, y)
        assert len(u) <= len(set(x.tolist()) | set(y.tolist()))
        if len(u):
            assert max(collections.Counter(np.concatenate([u, v]).tolist()).values()) <= simhash.FAN + 1
        pairs = [[tuple(sorted(p)) for p in zip(s.tolist(), t.tolist(), strict=True)] for s, t in ((x, y), (u, v))]

        def groups(links):
            root = {}

            def find(q):
                while root.setdefault(q, q) != q:
                    q = root[q]
                return q

            for s, t in links:
                root[find(s)] = find(t)
            out = collections.defaultdict(set)
            for q in root:
                out[find(q)].add(q)
            return {frozenset(g) for g in out.values() if len(g) > 1}

        assert groups(pairs[0]) == groups(pairs[1])


def test_simhash_empty(empty):
    assert simhash.simhash_dedup(empty).count() == 0


# ---- alignment ----------------------------------------------------------------------------------

def measures(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = alignment.default_paths()
    a_model, b_model = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a_model.encode_special_tokens = True
    letters, spelled = alignment.byte_letters(), {i: t for t, i in a_model.get_vocab().items()}
    count, found = collections.Counter(), []
    for doc_id, text in rows:
        text = text or ""
        a = a_model.encode(" " + text, add_special_tokens=False).ids
        b = b_model.encode(text)
        bytes_a = [bytes(letters[c] for c in spelled[i]) for i in a]
        bytes_b = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            found.append((doc_id, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        groups, links, x, y = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(end, x) + 1, ends_b.index(end, y) + 1
            groups.append(",".join(map(str, a[x:to_a])) + "|" + ",".join(map(str, b[y:to_b])))
            links.append((a[to_a - 1], b[to_b - 1]))
            x, y = to_a, to_b
        count.update(links)
        found.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = collections.Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [
        (i, a, b, len(s), len(s), sum(count[x] == top[x[1]] for x in s), sum(count[x] for x in s), digest) for i, a, b, s, digest in found
    ]


@pytest.fixture(scope="module")
def texts(spark, table):
    odd = [
        "▁marker of its own", "<|endoftext|> </s> <s> plain", "tab\tand\r\nlines\n\n", "  two  spaces ", "日本語のテキスト😀👍🏽", " nbsp　wide",
        "don't WE'LL 12345 a+b=c", "x" * 3000, "́combining é", "copy", "copy", "copy",
    ]
    return table.unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(odd)], "doc_id bigint, text string")).cache()


@pytest.mark.parametrize("at_once", [alignment.PAIRS_AT_ONCE, 0])
def test_alignment_is_brute_force(texts, at_once):
    want = measures([tuple(r) for r in texts.collect()])
    found = alignment.align(texts.withColumn("key", F.lit("x")).withColumn("pair", F.lit(1)), at_once=at_once)
    assert found.columns == ["doc_id", *alignment.MEASURES, "groups_sha256"]
    assert same(found.collect(), want)


def test_alignment_encodes_each_text_once(docs):
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).filter("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    found = alignment.aligned_texts(texts.withColumn("key", alignment.text_key(F.col("text"))), alignment.default_paths())
    assert found.count() == docs.filter("text <> ''").select("text").distinct().count()
    assert found.agg(F.max("copies")).first()[0] == 3


def test_alignment_empty(empty):
    assert alignment.align(empty).count() == 0
