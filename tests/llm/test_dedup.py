"""Exact, near and substring dedup against brute force, and their defined results on odd rows."""

import hashlib

import corpus_pipeline

from matchbook.llm import exact_dedup, near_dedup, substring_dedup


def test_exact(docs):
    out = exact_dedup.exact_dedup(docs).collect()
    assert len(out) == docs.count()
    by = {}
    for r in out:
        by.setdefault(r.text_sha256, []).append(r)
    for group in by.values():
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert sum(r.kept for r in group) == 1
        assert all(r.group_size == len(group) and r.keep_id == (max(ids) if ids else None) for r in group)
    assert by[hashlib.sha256(b"").hexdigest()][0].group_size == 2  # empty and null


def test_exact_heavy_path(spark):
    rows = spark.range(400).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) as text")
    heavy = exact_dedup.heavy_groups(exact_dedup.digests(rows), support=0.01, min_rows=32).collect()
    assert [(h.group_size, h.keep_id) for h in heavy] == [(134, 399)]
    out = exact_dedup.exact_dedup(rows, support=0.01).filter("kept").collect()
    assert len(out) == 267


def test_exact_stage_keeps_columns(docs):
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 2, 3, 5, 6, 7, 8, 9]


def test_near(docs):
    out = {(r.doc_id, r.kept): r for r in near_dedup.near_dedup(docs).collect()}
    assert {k[0] for k, r in out.items() if r.class_id == 1} == {1, 2, 3}
    assert out[1, True].class_size == 4 and out[1, True].n_links == 1
    assert all(out[i, True].class_size == 1 for i in (4, 5, 6, 7, 8, 9, None))


def test_near_chain_and_family(spark):
    """a ~ b ~ c without a ~ c is one class; block comparison finds what a star would miss."""
    words = [f"w{i}" for i in range(200)]

    def edit(ws, at):
        return [("e%d" % i if i in at else w) for i, w in enumerate(ws)]

    a, b, c = words, edit(words, {5, 60, 130}), edit(words, {5, 60, 130, 20, 90, 160})
    df = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c)), (4, "quite different " * 9)], "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.near_dedup(df).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
    sets = [(i, i, 7, list(range(i, 100 + i))) for i in (0, 5, 40)]
    members = spark.createDataFrame(sets, "member bigint, class bigint, family bigint, set array<bigint>")
    got = near_dedup.family_links(members, 0.8, block=1).collect()
    assert [(r.a, r.b) for r in got] == [(0, 5)]


def brute_classes(rows):
    """Least id of each row's class: components of Jaccard >= 0.8 of five-word shingles."""
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, w in ((d, t.split()) for d, t in rows)}
    of = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and of[a] != of[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((of[a], of[b]))
                of = {d: low if c == high else c for d, c in of.items()}
    return of


def test_near_unequal_repeats(spark):
    """Texts whose lines repeat a different number of times share most shingles but not their weights."""
    rows = []
    for i in range(30):
        head, line = ([f"{k}{i}x{j}" for j in range(n)] for k, n in (("h", 100), ("l", 20)))
        rows += [(2 * i, " ".join(head + line)), (2 * i + 1, " ".join(head + line * 300))]
    want = brute_classes(rows)
    assert all(want[d] == d - d % 2 for d in want)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.near_dedup(df).collect()} == want
    assert sorted(r.doc_id for r in corpus_pipeline.without_near_copies(spark, df, "").collect()) == sorted(set(want.values()))


def test_near_links_of_ties(spark):
    """Members that meet equally many others: the leader, and so n_links, doesn't depend on the order of the rows."""
    sets = spark.createDataFrame([(m, list(range(20))) for m in range(5)], "member bigint, set array<bigint>")
    for order in (1, -1):
        rows = [(7, m, 20, 5) for m in range(5)][::order]
        buckets = spark.createDataFrame(rows, "band bigint, member bigint, size bigint, weight bigint").coalesce(1)
        found, _ = near_dedup.links(buckets, sets)
        assert sorted((r.a, r.b) for r in found.collect()) == [(m, 4) for m in range(4)]


def test_near_stage(docs):
    left = near_dedup.drop_near(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 1, 4, 5, 6, 7, 8, 9]


def brute_substrings(rows):
    seen = {}
    words = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in words:
        for s in range(len(w) - 49):
            k = tuple(w[s : s + 50])
            seen[k] = min(seen.get(k, d), d)
    out = {}
    for d, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - 49):
            if seen[tuple(w[s : s + 50])] < d:
                gone[s : s + 50] = [True] * 50
        keep = [x for x, g in zip(w, gone) if not g]
        out.setdefault(d, set()).add((len(w), sum(gone), hashlib.sha256(b" ".join(keep)).hexdigest()))
    return out


def test_substrings(spark, docs):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(20, f"start {passage} end"), (21, f"{passage[:200]} other {passage} more"), (22, passage), (23, "p " * 49)]
    more = spark.createDataFrame(rows, "doc_id bigint, text string")
    every = docs.filter("doc_id is not null").select("doc_id", "text").unionByName(more)
    want = brute_substrings([(r.doc_id, r.text) for r in every.collect()])
    got = {}
    for r in substring_dedup.substring_dedup(every).collect():
        got.setdefault(r.doc_id, set()).add((r.n_words, r.n_removed, r.kept_sha256))
    assert got == want


def test_empty_tables(empty):
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert near_dedup.near_dedup(empty).count() == 0
    assert substring_dedup.substring_dedup(empty).count() == 0
