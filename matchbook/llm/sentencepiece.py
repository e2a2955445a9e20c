"""SentencePiece encoding as a max-plus parallel scan, and decoding.

The model at hand is of the merging kind: pieces merge in the order of their scores. Such an encoding is the one
path through the piece lattice on which every two neighbours stay apart when encoded by themselves, so it is the
path of largest weight where a pair of neighbours weighs 0 if it stays apart and minus infinity if it merges: a
max-plus problem over {0, -inf}, whose ids are those of the library itself. Spaces become the marker U+2581 and
one marker goes in front; a character that is no piece becomes the byte pieces of its UTF-8 form. Only pieces of
markers alone hold a marker after their first character, so a marker after another character always begins a
piece: what lies between such cuts is solved once, by merging, and remembered.

Giant texts are cut into chunks of ``CHUNK`` characters at any place, dealt out to tasks. The boundary state of a
chunk is the piece that holds the character before it: how many of its characters lie before the boundary and
how many after. Each chunk yields its transfer matrix T[in, out]; matrices combine associatively by the max-plus
product, first within blocks of ``SCAN`` chunks, then over the blocks of a text, which fixes every boundary
state; then every chunk is traced back on its own.

Decoding joins the pieces, turns markers into spaces, byte pieces into their bytes, and drops the marker in
front. A marker character of the text itself is encoded by its bytes, so decoding gives back every text.

Defined results: a null or empty text has no ids and decodes to the empty text; unknown or null ids decode to
nothing; of equally scored merges the leftmost goes first; repeated rows and ids are encoded alike; an empty
table gives an empty table. Extra columns of any name are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.llm.common import kept, prepared

MARK = "▁"
#: Stands for a marker of the text itself while it is encoded (no decoded text has a lone surrogate).
OWN_MARK = "\udc81"
CHUNK = 8192
#: Texts longer than this are cut into chunks; chunks whose matrices one task combines.
GIANT = 4 * CHUNK
SCAN = 256
#: Pairs of pieces that a task remembers.
MEMO = 1 << 16
#: Texts encoded at once.
ROWS = 256
NEVER = float("-inf")


def default_model() -> str:
    """Path of the public piece vocabulary installed with Python."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Pieces:
    """id and score of each piece that text can use, longest length, byte pieces, and the text of each id."""

    ids: dict[str, tuple[int, float]]
    longest: int
    bytes: list[int]
    strings: list[str]
    scores: dict[str, float]
    #: The model, set to add no space in front.
    model: bytes

    def plain(self) -> tuple:
        """The fields as built-in types: a broadcast is pickled by reference to classes, which workers may not have."""
        return self.ids, self.longest, self.bytes, self.strings, self.scores, self.model

    @staticmethod
    def load(path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        ids, raw, strings = {}, [0] * 256, []
        for i, p in enumerate(model.pieces):
            text = ""
            if p.type == p.BYTE:
                value = int(p.piece[3:5], 16)
                raw[value] = i
                text = chr(value) if value < 0x80 else chr(0xDC00 + value)
            elif p.type in (p.NORMAL, p.USER_DEFINED):
                ids[p.piece] = (i, float(p.score))
                text = p.piece.replace(MARK, " ")
            strings.append(text)
        model.normalizer_spec.add_dummy_prefix = False
        model.normalizer_spec.remove_extra_whitespaces = False
        scores = {x: score for x, (_, score) in ids.items()}
        return Pieces(ids, max(map(len, ids)), raw, strings, scores, model.SerializeToString())


def escaped(text: str | None) -> str:
    return MARK + text.replace(MARK, OWN_MARK).replace(" ", MARK) if text else ""


class Encoder:
    """Encodes stretches between cuts, and chunks between boundary states."""

    def __init__(self, pieces: Pieces) -> None:
        import sentencepiece

        self.p = pieces
        self.library = sentencepiece.SentencePieceProcessor(model_proto=pieces.model)
        self.pairs: dict[tuple[str, str], bool] = {}
        alone = "\n" if not any("\n" in x and len(x) > 1 for x in pieces.ids) else ""
        self.cut = re.compile(f"(?<=[^{MARK}]){MARK}")
        self.stretch = re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + ("|\n" if alone else ""))
        n = pieces.longest
        #: State 0 is the beginning of a text; else (characters before the boundary, characters after it).
        self.states = [(0, 0)] + [(b, e) for b in range(1, n + 1) for e in range(n + 1 - b)]
        self.state = {x: i for i, x in enumerate(self.states)}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text: the best-scored pair of neighbours merges until none is a piece."""
        get, none, parts = self.p.scores.get, NEVER, list(text)
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while scores:
            best = max(scores)
            if best == none:
                break
            i = scores.index(best)
            parts[i] += parts.pop(i + 1)
            del scores[i]
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], none)
        return parts

    def apart(self, a: str, b: str) -> bool:
        """Weight 0 (true) or minus infinity of two neighbours."""
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            found = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return found

    def reach(self, text: str, entries: dict[int, dict[int, int]], stop: int) -> list[dict[int, int]]:
        """Entries reach[end][begin] = a set of entry states, as bits: along which of them a piece begin..end
        lies on a path of weight 0. ``entries`` is the same for the pieces that come in; begin -1: no piece.
        Pieces begin before ``stop``."""
        out: list[dict[int, int]] = [{} for _ in range(len(text) + 1)]
        for end, found in entries.items():
            out[end].update(found)
        ids, longest = self.p.ids, self.p.longest
        for i in range(stop):
            if not out[i]:
                continue
            for end in range(i + 1, min(len(text), i + longest) + 1):
                piece = text[i:end]
                if end > i + 1 and piece not in ids:
                    continue
                bits = 0
                for begin, have in out[i].items():
                    if begin < 0 or self.apart(text[begin:i], piece):
                        bits |= have
                if bits:
                    out[end][i] = out[end].get(i, 0) | bits
        return out

    def back(self, text: str, reach: list[dict[int, int]], bit: int, begin: int, end: int, stop: int) -> list[str]:
        """Pieces from the last one (begin, end) back to where a piece comes in at or before ``stop``."""
        out = []
        while end > stop:
            out.append(text[begin:end])
            # of the pieces that end here on this entry's paths, the one that stays apart
            before = [x for x, have in reach[begin].items() if have & bit and (x < 0 or self.apart(text[x:begin], out[-1]))]
            if begin <= stop or not before:
                break
            begin, end = before[0], begin
        out.reverse()
        return out

    def numbers(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for x in pieces:
            found = self.p.ids.get(x)
            out.extend((found[0],) if found else [self.p.bytes[b] for b in (MARK if x == OWN_MARK else x).encode("utf-8")])
        return out

    def lattice(self, text: str) -> list[str]:
        """Pieces of a text of any length, along the lattice."""
        reach = self.reach(text, {0: {-1: 1}}, len(text))
        ((begin, _),) = reach[-1].items()
        return self.back(text, reach, 1, begin, len(text), 0)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """ids of escaped texts that begin and end at cuts."""
        found = self.library.encode(["" if OWN_MARK in t else t.replace(MARK, " ") for t in texts], num_threads=1)
        for i, text in enumerate(texts):
            if OWN_MARK in text:
                found[i] = [x for stretch in self.stretch.findall(text) for x in self.solved(stretch)]
        return found

    def solved(self, stretch: str) -> list[int]:
        return self.numbers(self.lattice(stretch)) if OWN_MARK in stretch else self.library.encode(stretch.replace(MARK, " "))

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def cuts(self, text: str, begin: int, end: int) -> tuple[int, int] | None:
        """First and last place in begin+1 .. end-1 where a piece must begin."""
        first = self.cut.search(text, begin + 1, end)
        if not first:
            return None
        last = text.rfind(MARK, first.start(), end)
        while text[last - 1] == MARK:
            last -= 1
        return first.start(), max(last, first.start())

    def entries(self, text: str, at: int, only: int | None = None) -> dict[int, dict[int, int]]:
        """The pieces that may hold the character before place ``at``, each with its state's bit."""
        out: dict[int, dict[int, int]] = {}
        for i, (b, e) in enumerate(self.states):
            if only is not None and i != only:
                continue
            if i == 0:
                if at == 0:
                    out.setdefault(0, {})[-1] = 1
            elif b <= at and at + e <= len(text) and (b + e == 1 or text[at - b : at + e] in self.p.ids):
                out.setdefault(at + e, {})[at - b] = 1 << i
        return out

    def exits(self, reach: list[dict[int, int]], size: int) -> np.ndarray:
        """For each entry state (rows): which pieces hold the character before place ``size``."""
        out = np.zeros((len(self.states),) * 2, bool)
        for end in range(size, min(len(reach), size + self.p.longest)):
            for begin, bits in reach[end].items():
                state = self.state.get((size - begin, end - size))
                if begin >= size or state is None:
                    continue
                while bits:
                    low = bits & -bits
                    out[low.bit_length() - 1, state] = True
                    bits ^= low
        return out

    def matrix(self, text: str, at: int, size: int) -> np.ndarray:
        """Transfer matrix (true: weight 0) of the chunk ``text[at : at + size]``; ``text`` has longest - 1 characters
        more on either side where there are any."""
        end = at + size
        cut = self.cuts(text, at, end)
        if cut is None:
            return self.exits(self.reach(text, self.entries(text, at), end), end)
        first, last = cut
        head = self.reach(text[:first], self.entries(text[:first], at), first)[first]
        bits = 0
        for have in head.values():
            bits |= have
        enter = np.array([bits >> i & 1 for i in range(len(self.states))], bool)
        leave = self.exits(self.reach(text[last:], {0: {-1: 1}}, end - last), end - last)[0]
        return enter[:, None] & leave[None, :]

    def chunk(self, text: str, at: int, size: int, enter: int, leave: int) -> list[int]:
        """ids of the pieces that begin in a chunk, from state to state."""
        end, (b, e) = at + size, self.states[leave]
        stop = at + self.states[enter][1]
        if end - b < stop:  # the piece that came in passes over the whole chunk
            return []
        cut = self.cuts(text, at, end)
        if cut is None:
            reach = self.reach(text, self.entries(text, at, enter), end)
            return self.numbers(self.back(text, reach, 1 << enter, end - b, end + e, stop))
        first, last = cut
        out: list[int] = []
        if first > stop:
            head = self.reach(text[:first], self.entries(text[:first], at, enter), first)
            begin = next(x for x, have in head[first].items() if have >> enter & 1)
            out += self.numbers(self.back(text[:first], head, 1 << enter, begin, first, stop))
        out += self.encode(text[first:last])
        tail = text[last:]
        reach = self.reach(tail, {0: {-1: 1}}, end - last)
        return out + self.numbers(self.back(tail, reach, 1, end - b - last, end + e - last, 0))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product over {0, -inf}, held as {true, false}; associative."""
    return (a.astype(np.float32) @ b.astype(np.float32)) > 0


def states(matrices: list[np.ndarray], enter: int, leave: int | None) -> list[int]:
    """Boundary states around a row of matrices on the path of weight 0 from ``enter`` to ``leave`` (None: the
    state in which a text ends)."""
    have = np.zeros(len(matrices[0]), bool)
    have[enter] = True
    front = [have]
    for m in matrices:
        front.append((front[-1][:, None] & m).any(0))
    path = [int(front[-1].argmax()) if leave is None else leave]
    for m, f in zip(matrices[::-1], front[-2::-1], strict=True):
        path.append(int((f & m[:, path[-1]]).argmax()))
    return path[::-1]


def _matrix(raw: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(raw, np.uint8)).astype(bool)
    n = int(len(bits) ** 0.5)
    return bits[: n * n].reshape(n, n)


def _packed(matrix: np.ndarray) -> bytes:
    return np.packbits(matrix).tobytes()


def _small(docs: DataFrame, pieces) -> DataFrame:
    def run(batches):
        encoder = Encoder(Pieces(*pieces.value))
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                rows = batch.slice(begin, ROWS)
                found = encoder.encode_all([escaped(t) for t in rows.column(1).to_pylist()])
                edge = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(found), np.int32, int(edge[-1]))
                ids = pa.ListArray.from_arrays(pa.array(edge), pa.array(flat))
                yield pa.RecordBatch.from_arrays([rows.column(0), ids], names=["row", "ids"])

    return docs.mapInArrow(run, "row bigint, ids array<int>")


def _chunks(docs: DataFrame, size: int, longest: int) -> DataFrame:
    """row, c, last, text: the chunks of every text, each with the characters on either side that a piece across
    its boundary may take."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                text = escaped(batch.column(1)[i].as_py())
                n = -(-len(text) // size)
                for c in range(0, n, 512):
                    part = range(c, min(n, c + 512))
                    cut = [text[max(0, x * size - longest) : (x + 1) * size + longest - 1].encode("utf-8", "surrogatepass") for x in part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array([i] * len(part))), pa.array(list(part), pa.int64()),
                            pa.array([x == n - 1 for x in part]), pa.array(cut, pa.binary()),
                        ],
                        names=["row", "c", "last", "text"],
                    )

    return docs.mapInArrow(run, "row bigint, c bigint, last boolean, text binary")


def _place(row: dict, size: int, longest: int) -> tuple[str, int, int]:
    """(text, where the chunk begins in it, its size)."""
    text = row["text"].decode("utf-8", "surrogatepass")
    at = min(longest, row["c"] * size)
    return text, at, len(text) - at if row["last"] else size


def _matrices(chunks: DataFrame, pieces, size: int) -> DataFrame:
    """row, c, matrix of every chunk."""

    def run(batches):
        encoder = Encoder(Pieces(*pieces.value))
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                out.append(_packed(encoder.matrix(*_place(row, size, encoder.p.longest))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["row", "c", "matrix"])

    return chunks.mapInArrow(run, "row bigint, c bigint, matrix binary")


def _ordered(t: pa.Table, by: str) -> list[np.ndarray]:
    return [_matrix(x) for x in t.sort_by(by).column("matrix").to_pylist()]


def _boundary_states(matrices: DataFrame) -> DataFrame:
    """row, c, enter, leave: the states around every chunk on its text's best path."""

    def block_product(t: pa.Table) -> pa.Table:
        whole = None
        for m in _ordered(t, "c"):
            whole = m if whole is None else product(whole, m)
        return pa.table({"row": t.column("row")[:1], "block": t.column("block")[:1], "matrix": pa.array([_packed(whole)], pa.binary())})

    def around(t: pa.Table, by: str, name: str, enter: int, leave: int | None) -> pa.Table:
        path = states(_ordered(t, by), enter, leave)
        place = t.sort_by(by)
        return pa.table(
            {"row": place.column("row"), name: place.column(by), "enter": pa.array(path[:-1], pa.int32()), "leave": pa.array(path[1:], pa.int32())}
        )

    def of_blocks(t: pa.Table) -> pa.Table:
        return around(t, "block", "block", 0, None)

    def of_chunks(t: pa.Table) -> pa.Table:
        return around(t, "c", "c", t.column("enter")[0].as_py(), t.column("leave")[0].as_py())

    blocked = matrices.withColumn("block", F.floor(F.col("c") / SCAN).cast("bigint"))
    products = blocked.groupBy("row", "block").applyInArrow(block_product, "row bigint, block bigint, matrix binary")
    edges = products.groupBy("row").applyInArrow(of_blocks, "row bigint, block bigint, enter int, leave int")
    inside = blocked.join(edges, ["row", "block"])
    return inside.groupBy("row", "block").applyInArrow(of_chunks, "row bigint, c bigint, enter int, leave int")


def _traced(chunks: DataFrame, pieces, size: int) -> DataFrame:
    """row, c, ids: every chunk traced back on its own between its boundary states."""

    def run(batches):
        encoder = Encoder(Pieces(*pieces.value))
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                out.append(encoder.chunk(*_place(row, size, encoder.p.longest), row["enter"], row["leave"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], names=["row", "c", "ids"])

    return chunks.select("row", "c", "last", "text", "enter", "leave").mapInArrow(run, "row bigint, c bigint, ids array<int>")


def encode(docs: DataFrame, model: str | None = None, size: int = CHUNK, giant: int = GIANT) -> DataFrame:
    """doc_id, ids: one row for each row of ``docs``. The model's piece table (bounded by its vocabulary) goes to
    every task."""
    spark = prepared(docs.sparkSession)
    table = Pieces.load(model or default_model())
    pieces = spark.sparkContext.broadcast(table.plain())
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("row"), text.alias("text"))
    small = _small(rows.filter(F.length("text") <= giant), pieces).withColumnRenamed("row", "doc_id")
    large = rows.filter(F.length("text") > giant).select(F.col("row").alias("doc_id"), "text")
    large = kept(large.withColumn("row", F.monotonically_increasing_id()), "giants")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = kept(_chunks(large.select("row", "text"), size, table.longest).repartition(n, "row", "c"), "chunks")
    around = _boundary_states(kept(_matrices(chunks, pieces, size), "matrices"))
    parts = _traced(chunks.join(around, ["row", "c"]), pieces, size)
    joined = parts.groupBy("row").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("c", "ids"))), lambda p: p["ids"])).alias("ids")
    )
    return small.unionByName(large.select("row", "doc_id").join(joined, "row").select("doc_id", "ids"))


def decode_ids(ids: list[int], strings: list[str]) -> str:
    text = "".join([strings[i] for i in ids if i is not None and 0 <= i < len(strings)])
    text = text[1:] if text.startswith(" ") else text
    try:
        text.encode("utf-8")
    except UnicodeEncodeError:
        text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
    return text


def decode(encoded: DataFrame, model: str | None = None, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` and the text of ``ids``; bytes that aren't UTF-8 become U+FFFD."""
    spark = prepared(encoded.sparkSession)
    strings = spark.sparkContext.broadcast(Pieces.load(model or default_model()).strings)

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                rows = batch.slice(begin, 256)
                texts = [decode_ids(x.values.to_pylist() if x.is_valid else [], strings.value) for x in rows.column(rows.num_columns - 1)]
                keep = [rows.column(i) for i in range(rows.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(texts, pa.string())], names=[*columns, "text"])

    source = encoded.select(*columns, "ids")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "ids")
    return source.mapInArrow(run, f"{fields}, text string")


def encoded_digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_hash (xxhash64 of the ids), decoded_sha256 (of the text decoded from them)."""
    ids = encode(docs, model).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), "ids")
    out = decode(ids, model, ("doc_id", "n_tokens", "ids_hash"))
    return out.select("doc_id", "n_tokens", "ids_hash", F.sha2("text", 256).alias("decoded_sha256"))
