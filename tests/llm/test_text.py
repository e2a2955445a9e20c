"""Decontamination, personal data, tokenization and the pipeline."""

import hashlib
import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from matchbook.llm import decontaminate, pii, sentencepiece

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards quietly box up five dozen liquor jugs"


def test_decontamination(spark, docs, empty):
    edited = ITEM.replace("lazy", "lzy").replace("seven", "sevven")
    far = "".join(c if i % 4 else "#" for i, c in enumerate(ITEM))
    more = spark.createDataFrame([(30, f"a {ITEM.upper()} b"), (31, f"x\n{edited} y"), (32, far)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (3, "short"), (4, " ")], "item_id bigint, text string")
    got = decontaminate.matches(docs.select("doc_id", "text").unionByName(more), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in got) == [(30, 1, 0), (31, 1, 2)]
    in_blocks = decontaminate.matches(more, bench, block_chars=40).collect()
    assert sorted((r.doc_id, r.edits) for r in in_blocks) == [(30, 0), (31, 2)]
    assert decontaminate.keep_clean(docs, bench).count() == docs.count()
    assert decontaminate.matches(docs, bench.limit(0)).count() == 0 and decontaminate.matches(empty, bench).count() == 0


def test_items_of_one_id(spark):
    """Every text of an item_id is searched, also of a null one; a document row reports an item_id once, at its best."""
    other = "pack my box with forty bags of rare coffee beans and then sail slowly home across the quiet bay"
    third, fourth = "zebra crossings hum beneath the copper moon tonight", "an old lighthouse keeper counts the ships at dawn"
    edited = ITEM.replace("lazy", "lzy").replace("seven", "sevven")
    texts = [f"a {ITEM} b", f"a {other} b", f"{edited} and {other}", f"x {third}", f"y {fourth}", "clean of all"]
    rows = [*((40 + i, t) for i, t in enumerate(texts)), (42, texts[2]), (None, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, ITEM), (1, other), (None, third), (None, fourth), (1, ITEM)], "item_id bigint, text string")
    want = [(-1, -1, 0), (40, 1, 0), (41, 1, 0), (42, 1, 0), (42, 1, 0), (43, -1, 0), (44, -1, 0)]
    for chars in (1 << 20, 40):
        got = [(-1 if r.doc_id is None else r.doc_id, -1 if r.item_id is None else r.item_id, r.edits)
               for r in decontaminate.matches(docs, bench, block_chars=chars).collect()]
        assert sorted(got) == want
        assert [r.doc_id for r in decontaminate.keep_clean(docs, bench, block_chars=chars).collect()] == [45]


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m.group().split(".")),
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_personal_data(spark, docs, empty):
    texts = ["a@b.c+d@e.f x@y z@w.q.r", "1.2.3.4.5.6.7.8 999.1.1.1 007.08.1.255", "4111 1111 1111 1111, 4111-1111-1111-1112",
             "+1 (555) 123-4567 ext +12 ((((", "é😀 a.b@c.de é 152.143.123.131###", "x" * 5000 + "@a.b", "1 " * 3000]
    rows = [(100 + i, t) for i, t in enumerate(texts)]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = {r.doc_id: base_spans(r.text or "") for r in every.collect()}
    out = pii.digested(pii.personal_data(every)).collect()
    assert len(out) == every.count()
    for r in out:
        spans = want[r.doc_id]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in BASE]
    assert pii.personal_data(empty).count() == 0


def test_bootstrap_finds_unseen(spark):
    seeds = [(i, f"contact user{i}@mail.org today") for i in range(6)]
    rows = [*seeds, (10, "contact KEY99881 today"), (11, "version 123456 only")]
    out = {r.doc_id: r.spans for r in pii.digested(pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()}
    assert out[10] == "context:8:16" and out[11] == ""


def test_sentencepiece_chunks_match_library():
    library = pytest.importorskip("sentencepiece")
    model = sentencepiece.default_model()
    whole = library.SentencePieceProcessor(model_file=model)
    pieces = sentencepiece.Pieces.load(model)
    encoder, longest, rng = sentencepiece.Encoder(pieces), pieces.longest, random.Random(5)
    parts = ["the", "in", " ", "  ", "é", "ch", "ing", "\n", "漢", "a", "tion", " of"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))
        s = sentencepiece.escaped(text)
        ids = encoder.encode(s)
        assert ids == whole.encode(text) and sentencepiece.decode_ids(ids, pieces.strings) == text
        for size in (3, 7, 20):
            n = -(-len(s) // size)
            cut = [(s[max(0, i * size - longest) : (i + 1) * size + longest - 1], min(longest, i * size)) for i in range(n)]
            place = [(t, at, len(t) - at if i == n - 1 else size) for i, (t, at) in enumerate(cut)]
            matrices = [encoder.matrix(*p) for p in place]
            path = sentencepiece.states(matrices, 0, None)
            assert sum((encoder.chunk(*p, path[i], path[i + 1]) for i, p in enumerate(place)), []) == ids


def test_sentencepiece_round_trip(docs, empty):
    ids = sentencepiece.encode(docs, size=500, giant=1000)
    back = sorted((r.doc_id or -1, r.text) for r in sentencepiece.decode(ids).collect())
    assert back == sorted((r.doc_id or -1, r.text or "") for r in docs.collect())
    assert sentencepiece.encode(empty).count() == 0


def test_pipeline(spark):
    docs = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = docs.collect()
    source = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert 0 < len(rows) <= len(source) and docs.columns[0] == "doc_id"
    assert all(r.decoded_sha256 == hashlib.sha256(source[r.doc_id].encode()).hexdigest() for r in rows)


def test_context_patterns_find_unseen_identifiers(spark):
    """A pattern is accepted by what it meets in the whole corpus: "card:" introduces identifiers only, "the" does not."""
    rng = random.Random(8)

    def card(valid):
        while True:
            digits = str(rng.randint(10**15, 10**16 - 1))
            if luhn(digits) == valid:
                return digits

    rows, want = [], set()
    for i in range(60):
        lead = "some words of the " + " ".join(rng.choice(["house", "tree", "river"]) for _ in range(9))
        unseen = None if i % 3 else (card(False) if i % 2 else f"PX-{i}-{'q' * 300 if i == 12 else 'q'}")
        text = f"{lead} the {card(True)} and  card: {unseen or card(True)}, the {card(False)} end\n"
        if unseen:
            want.add((i, text.index(unseen, text.index("card:")), len(unseen)))
        rows.append((i, text))
    rows += [(7, rows[7][1]), (100, None), (101, ""), (102, "card: "), (103, "card:  lonely_one")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = pii.personal_data(docs).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    got = set()
    for r in found:
        for s in r.spans:
            if s.kind == "context":
                token = texts[r.doc_id][s.begin : s.end].strip(",")
                got.add((r.doc_id, s.begin, len(token)))
    assert got == want | {(103, 7, len("lonely_one"))}
    # base spans are as without the method
    assert all(sum(s.kind == "card" for s in r.spans) == (2 if r.doc_id % 3 else 1) for r in found if r.doc_id < 60)


def test_no_context_without_seeds(spark, docs, empty):
    plain = spark.createDataFrame([(1, "card: abc card: def")], "doc_id bigint, text string")
    assert [r.spans for r in pii.personal_data(plain).collect()] == [[]]
    assert pii.personal_data(empty).count() == 0 and pii.personal_data(docs).count() == docs.count()


def test_pipeline_on_odd_rows(spark, docs, tmp_path):
    """Null, empty, blank, repeated and very long rows, extra columns; a benchmark with a null and a short item; no rows."""
    bench = spark.createDataFrame([(1, ITEM), (2, None), (None, "tiny")], "item_id bigint, text string")
    held = docs.limit(1).withColumns({"doc_id": F.lit(77).cast("bigint"), "text": F.lit(f"words before {ITEM} and after it, enough of them")})
    for name, rows in (("all", docs.unionByName(held)), ("none", docs.limit(0))):
        folder = str(tmp_path / name)
        rows.write.parquet(f"{folder}/documents.parquet")
        bench.write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        if name == "none":
            assert out == []
            continue
        source = {}
        for r in rows.collect():
            source.setdefault(r.doc_id, set()).add(hashlib.sha256((r.text or "").encode()).hexdigest())
        assert all(r.decoded_sha256 in source[r.doc_id] for r in out)
        ids = [r.doc_id for r in out]
        # blank texts and the one that holds the item are gone, of the copies and near copies one document stays
        assert len(ids) == len(set(ids)) and not set(ids) & {4, 5, 6, 7, 77}
        assert len(set(ids) & {1, 2, 3}) == 1
