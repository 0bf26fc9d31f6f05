"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The model is a BPE SentencePiece model with byte fallback, given by path; it is
only read, never trained. Encoding follows the model's own agenda: adjacent
symbols whose union is a piece wait in a priority queue, the best scored is
merged first, the leftmost on ties. With dropout, every popped candidate is
skipped with the rate as its chance, drawn from a 64-bit hash of the seed, the
document's key and the unit's place in the text: every occurrence of a word has
draws of its own, the same on every run and every executor. Rate 0 is plain
SentencePiece encoding.

No piece continues past a word start or a line end, so a text is encoded unit
by unit (white space run plus word). The gaps from skip to skip are geometric:
an occurrence whose first gap reaches past the end of its unit's dropout-free
agenda is plainly encoded, once for all such occurrences of a chunk; each other
occurrence runs an agenda of its own. Decoding joins the pieces' bytes. A literal U+2581 - the model's mark
for a space - is written as its bytes, so that decoding is lossless for every
text.

Defined results: null text gives null ids and decodes to null (lossless); an
empty text gives no ids; repeated rows give repeated, equal rows (unless
``copies`` of a key are told apart); an empty table gives an empty result; only
the key and the text are read, or, in ``encode``, extra columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirescope.llm import common as C

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RATE = 0.1
SEED = 17
VARIANTS = 64  # draws that the tests walk through; in a text every occurrence has its own, of 64 bits
LONGEST_KEPT = 48  # longer units are encoded one by one
ROWS = 50_000  # units whose agendas run side by side
MARK = "▁"


def ragged(values: np.ndarray, sizes: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``pick`` of ``values`` (cut into runs of ``sizes``) one after another, and their sizes."""
    begin = np.cumsum(sizes) - sizes
    n = sizes[pick]
    stop = np.cumsum(n)
    total = int(stop[-1]) if len(stop) else 0
    idx = np.arange(total) + np.repeat(begin[pick] - (stop - n), n)
    return values[idx], n


class Codec:
    """Encoder and decoder of one model at one dropout rate."""

    def __init__(self, model: str = MODEL, rate: float = RATE, seed: int = SEED) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        self.seed = C.mix64(np.array([seed & 0xFFFFFFFF], np.uint64) + np.uint64(1))
        # a gap reaches k candidates if its draw is below (1 - rate)^k
        stay, self.reach = 1.0, []
        while rate > 0 and (stay := stay * (1 - rate)) * 2.0 ** 64 >= 1:
            self.reach.append(int(stay * 2.0 ** 64))
        self.reach = np.array(self.reach[::-1], np.uint64)
        self.drops = rate > 0
        self.merges: dict[str, tuple[float, int]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                self.merges[piece] = (-sp.get_score(i), i)
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        self._tables()

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return np.array(ids, np.int32).tobytes()

    def _gaps(self, draws: np.ndarray, level: np.ndarray | int) -> np.ndarray:
        """Candidates popped before the skip number ``level`` of each occurrence, since the last skip."""
        u = C.mix64(draws + (np.atleast_1d(level).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        return len(self.reach) - np.searchsorted(self.reach, u, "right")

    def _skips(self, draw: np.uint64) -> Iterator[int]:
        """The numbers of an occurrence's skipped candidates."""
        last, level = -1, 0
        while self.drops:
            at = last + np.cumsum(self._gaps(np.full(256, draw, np.uint64), np.arange(level, level + 256)) + 1)
            yield from at.tolist()
            last, level = int(at[-1]), level + 256

    def _unit(self, unit: str, variant: int) -> bytes:
        """The ids of one unit by agenda, as packed int32; ``variant`` is its draw."""
        return self._packed(self._agenda(unit, self._skips(np.uint64(variant))))

    def _agenda(self, unit: str, skips: Iterator[int]) -> list[int]:
        """The ids of one unit by a priority queue, without the candidates of the numbers ``skips``."""
        merges = self.merges
        sym: list[str] = list(unit)
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        pops, skip = 0, next(skips, -1)
        agenda: list[tuple[float, int, int, int]] = []
        for i in range(n - 1):
            m = merges.get(sym[i] + sym[i + 1])
            if m:
                agenda.append((m[0], i, m[1], 2))
        heapq.heapify(agenda)
        while agenda:
            _, i, piece, size = heapq.heappop(agenda)
            j = right[i]
            # gone, or merged with something else meanwhile
            if j < 0 or not sym[i] or len(sym[i]) + len(sym[j]) != size:
                continue
            pops += 1
            if pops - 1 == skip:
                skip = next(skips, -1)
                continue
            merged = sym[i] = sym[i] + sym[j]
            sym[j] = ""
            j = right[i] = right[j]
            if j >= 0:
                left[j] = i
                m = merges.get(merged + sym[j])
                if m:
                    heapq.heappush(agenda, (m[0], i, m[1], len(merged) + len(sym[j])))
            j = left[i]
            if j >= 0:
                m = merges.get(sym[j] + merged)
                if m:
                    heapq.heappush(agenda, (m[0], j, m[1], len(merged) + len(sym[j])))
        ids: list[int] = []
        for s in sym:
            if s:
                m = merges.get(s)
                if m:
                    ids.append(m[1])
                else:
                    ids.extend(self.byte_ids[b] for b in s.encode())
        return ids

    def _units(self, units: list[str], variants: np.ndarray) -> list[bytes]:
        """``_unit`` of many units."""
        text = "".join(units)
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        size = np.array([len(u) for u in units])
        ids, n, _ = self._side_by_side(self.char_ids[chars], np.cumsum(size) - size, size,
                                       np.asarray(variants).astype(np.uint64), np.frombuffer(text.encode(), np.uint8))
        return [ids[e - k:e].tobytes() for e, k in zip(np.cumsum(n).tolist(), n.tolist(), strict=True)]

    def _side_by_side(self, chars: np.ndarray, begin: np.ndarray, size: np.ndarray, draws: np.ndarray | None,
                      data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of many units one after another, their numbers of ids, and of candidates popped.

        ``chars`` are the symbols of all characters of ``data``, ``begin`` and ``size`` the units
        in it; no ``draws``, no skips. Those of like length share a matrix.
        """
        n, pops = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        order = np.argsort(size, kind="stable")
        sizes = size[order]
        done, places, at = [], [], 0
        while at < len(order):
            to = min(int(np.searchsorted(sizes, sizes[at] + 3, "right")), at + ROWS)
            part = order[at:to]
            sym, where, n[part], pops[part] = self._matrix(
                chars, begin[part], size[part], None if draws is None else draws[part])
            done.append(sym)
            places.append(where)
            at = to
        if not done:
            return np.zeros(0, np.int32), n, pops
        sym, where = np.concatenate(done), np.concatenate(places)
        odd = np.flatnonzero(sym >= len(self.bytes_of))
        if len(odd):  # a character that is no piece gives its bytes
            first = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            width = np.ones(len(sym), np.int64)
            width[odd] = first[where[odd] + 1] - first[where[odd]]
            stop = np.cumsum(width)
            out = np.repeat(sym, width)
            part = np.arange(int(width[odd].sum())) - np.repeat(np.cumsum(width[odd]) - width[odd], width[odd])
            byte = np.array(self.byte_ids, np.int32)[data[np.repeat(first[where[odd]], width[odd]) + part]]
            out[np.repeat(stop[odd] - width[odd], width[odd]) + part] = byte
            row = np.repeat(order, n[order])
            n = np.bincount(row, width, len(size)).astype(np.int64)
            sym = out
        # from the order of lengths to that of the units
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return ragged(sym, n[order], back)[0], n, pops

    def _matrix(self, chars: np.ndarray, begin: np.ndarray, size: np.ndarray,
                draws: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The symbols of units, each one's first character, the symbols per unit, and the pops.

        The agendas of all units are rows of a matrix, row by row the same as ``_agenda``:
        ``rank`` holds the waiting candidates at their left symbols' places, every round pops
        the smallest (leftmost on ties) of every row and skips it or merges, and a merge renews
        the candidates at its two sides. Symbols are linked, so nothing moves.
        """
        n, width = len(size), int(size.max())
        step = width + 2  # a column without symbol at either side
        cols = np.arange(width)
        sym = np.full((n, step), self.no_symbol, np.int32)
        inside = cols < size[:, None]
        sym[:, 1:-1][inside] = chars[(begin[:, None] + cols)[inside]]
        after = np.tile(np.arange(1, step + 1, dtype=np.int16), (n, 1))
        before = after - np.int16(2)
        rank = np.full((n, step), self.no_rank, np.int32)
        rank[:, 1:-1] = self._pairs(sym[:, 1:-1], sym[:, 2:])
        gone = np.zeros((n, step), bool)
        s, r, a, b, g = sym.ravel(), rank.ravel(), after.ravel(), before.ravel(), gone.ravel()
        pops = np.zeros(n, np.int64)
        live, waiting = np.arange(n), rank  # waiting: the rows of rank that live (or a little more)
        skip = self._gaps(draws, 0) if draws is not None else None
        level = np.ones(n, np.int64)
        pop = 0  # every row pops one candidate a round
        while len(live):
            best = waiting.argmin(axis=1) if waiting is rank else rank[live].argmin(axis=1)
            base = live * step
            here = base + best
            top = r[here]
            go = top != self.no_rank
            if not go.all():
                pops[live[~go]] = pop
                live, base, here, top, waiting = live[go], base[go], here[go], top[go], None
                if not len(live):
                    break
            if skip is not None:
                hit = skip[live] == pop
                if hit.any():
                    rows = live[hit]
                    r[here[hit]] = self.no_rank
                    skip[rows] = pop + 1 + self._gaps(draws[rows], level[rows])
                    level[rows] += 1
                    base, here, top = base[~hit], here[~hit], top[~hit]
            pop += 1
            if not len(here):
                continue
            gone_at = base + a[here]
            far = a[gone_at]
            right = base + far
            left = base + b[here]
            made = self.piece_at[top]
            s[here] = made
            g[gone_at] = True
            r[gone_at] = self.no_rank
            a[here] = far
            b[right] = here - base
            both = self._pairs(np.concatenate([s[left], made]), np.concatenate([made, s[right]]))
            r[left], r[here] = both[:len(here)], both[len(here):]
        stays = inside & ~gone[:, 1:-1]
        return sym[:, 1:-1][stays], (begin[:, None] + cols)[stays], stays.sum(axis=1), pops

    def _tables(self) -> None:
        """Symbols are pieces and single characters; a pair of them that makes a piece has its rank."""
        names = {p: i for p, (_, i) in self.merges.items()}
        singles = sorted({c for p in self.merges for c in p} - names.keys())
        extra = len(self.bytes_of)
        symbols = names | {c: extra + k for k, c in enumerate(singles)}
        self.no_symbol = extra + len(singles)
        self.radix = self.no_symbol + 1
        order = {i: r for r, i in enumerate(sorted((i for _, i in self.merges.values()),
                                                   key=lambda i, s={i: s for s, i in self.merges.values()}: (s[i], i)))}
        pairs: dict[int, tuple[int, int]] = {}
        for p, i in names.items():
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.radix + b] = (order[i], i)
        self.no_rank = np.int32(np.iinfo(np.int32).max)
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys = keys
        self.pair_rank = np.array([pairs[k][0] for k in keys.tolist()], np.int32)
        self.piece_at = np.array(sorted(order, key=order.get), np.int32)  # by rank
        self.char_ids = np.full(0x110000, self.no_symbol, np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.char_ids[ord(c)] = i

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.radix + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], self.no_rank)

    def encode_texts(self, texts: pa.Array, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of whole texts, where each text's begin and end, and the bytes that they stand for.

        The bytes are the texts', each text that is not empty behind one space (the
        model's mark of a text's start). ``turns`` are the documents' keys as 64-bit hashes.
        """
        raw, ends = C.text_bytes(texts)
        lens = np.diff(ends)
        full = np.flatnonzero(lens)
        # one space before every text that is not empty
        data = np.full(len(raw) + len(full), 0x20, np.uint8)
        data[np.arange(len(raw)) + np.repeat(np.arange(1, len(full) + 1), lens[full])] = raw
        first = ends[:-1][full] + np.arange(len(full))
        if not len(full):
            return np.zeros(0, np.int32), np.zeros(len(lens) + 1, np.int64), data
        # units: white space run and word; a line end and a literal mark stand alone
        start = np.zeros(len(data) + 1, bool)
        space, line = data == 0x20, data == 0x0A
        start[:-1] = line
        start[1:] |= line
        start[1:-1] |= space[1:] & ~space[:-1]
        start[first] = True
        marks = np.flatnonzero(data == 0xE2)
        marks = marks[marks + 2 < len(data)]
        marks = marks[(data[marks + 1] == 0x96) & (data[marks + 2] == 0x81)]
        start[marks] = start[marks + 3] = True
        starts = np.flatnonzero(start[:-1])
        sizes = np.diff(np.append(starts, len(data)))
        text_of = np.searchsorted(first, starts, "right") - 1
        begin = np.searchsorted(starts, first)
        place = (np.arange(len(starts)) - begin[text_of]).astype(np.uint64)
        draws = C.mix64(C.mix64(turns.astype(np.uint64)[full] + self.seed)[text_of]
                        + place * np.uint64(0xD6E8FEB86659FD93))
        # the characters' symbols; a literal mark is none
        flat = data.tobytes()
        points = np.frombuffer(flat.decode().encode("utf-32-le"), np.uint32)
        chars = self.char_ids[points]
        chars[points == 0x20] = self.char_ids[ord(MARK)]
        chars[points == ord(MARK)] = self.no_symbol
        char_at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        begins = np.searchsorted(char_at, starts)
        widths = np.diff(np.append(begins, len(points)))

        short = np.flatnonzero(widths <= LONGEST_KEPT)
        _, at, inverse = np.unique(C.run_hashes(data, starts, sizes)[short], return_index=True, return_inverse=True)
        at = short[at]
        ids, counts, pops = self._side_by_side(chars, begins[at], widths[at], None, data)
        node = np.zeros(len(starts), np.int64)  # of every occurrence, the place of its ids
        node[short] = inverse
        if self.drops:
            own = short[self._gaps(draws[short], 0) < pops[inverse]]
            node[own] = len(counts) + np.arange(len(own))
            more, n, _ = self._side_by_side(chars, begins[own], widths[own], draws[own], data)
            ids, counts = np.concatenate([ids, more]), np.concatenate([counts, n])
        long = np.flatnonzero(widths > LONGEST_KEPT)
        if len(long):
            units = [flat[starts[i]:starts[i] + sizes[i]].decode().replace(" ", MARK) for i in long]
            more = [self._agenda(u, self._skips(draws[i])) for u, i in zip(units, long, strict=True)]
            node[long] = len(counts) + np.arange(len(long))
            ids = np.concatenate([ids, *(np.array(m, np.int32) for m in more)])
            counts = np.append(counts, [len(m) for m in more])
        out, n = ragged(ids, counts, node)
        per_text = np.zeros(len(lens) + 1, np.int64)
        per_text[full + 1] = np.add.reduceat(n, begin)
        return out, np.cumsum(per_text), data

    def decode_flat(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, each text's with its leading space."""
        if not hasattr(self, "piece_bytes"):
            self.piece_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
            self.piece_size = np.array([len(b) for b in self.bytes_of], np.int64)
        return ragged(self.piece_bytes, self.piece_size, ids)[0]

    def encode(self, text: str, turn: int = 0) -> np.ndarray:
        """The ids of a whole text."""
        return self.encode_texts(pa.array([text], pa.string()), np.array([turn]))[0]

    def same(self, ids: np.ndarray, ends: np.ndarray, data: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Per text: do its ids decode to it?"""
        if np.array_equal(self.decode_flat(ids), data):
            return np.ones(len(ends) - 1, bool)
        return np.array([t is None or self.decode(ids[a:b]) == t
                         for t, a, b in zip(texts.to_pylist(), ends[:-1], ends[1:], strict=True)])

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text that was encoded."""
        names = self.bytes_of
        if len(ids) == 0:
            return ""
        return b"".join([names[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])[1:].decode()


def key_hash(key: object) -> int:
    """64 bits that name a document."""
    return int.from_bytes(hashlib.blake2b(str(key).encode(), digest_size=8).digest(), "little")


_CODECS: dict[tuple, Codec] = {}


def codec(model: str, rate: float, seed: int) -> Codec:
    """One codec per worker process."""
    key = (model, rate, seed)
    if key not in _CODECS:
        _CODECS[key] = Codec(*key)
    return _CODECS[key]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL,
           rate: float = RATE, seed: int = SEED, ids: str = "ids", lossless: str | None = None,
           copies: bool = False) -> DataFrame:
    """``docs`` plus the ids of the whole text; ``lossless`` names a column that tells if decoding gave the text back.

    With ``copies``, equal rows, as the mix writes a document that it takes twice, are numbered, and the
    number is part of the key: each copy has draws of its own, however the rows are dealt. (They are
    counted by one aggregation over the rows, partial first, and written out again.)
    """
    copy = "__sp_copy"
    if copies:
        docs = docs.groupBy(*docs.columns).agg(F.count("*").cast("int").alias(copy)).withColumn(
            copy, F.explode(F.sequence(F.lit(0), F.col(copy) - 1)))
    extra = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if lossless:
        extra.append(T.StructField(lossless, T.BooleanType()))
    schema = T.StructType([*docs.schema.fields, *extra])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model, rate, seed)
        for b in C.chunks(batches, text, 2 << 20):
            texts = b.column(text)
            keys = b.column(key).to_pylist()
            if copies:
                keys = [f"{k}#{n}" if n else k for k, n in zip(keys, b.column(copy).to_pylist(), strict=True)]
            turns = np.array([key_hash(k) for k in keys], np.uint64)
            flat, ends, data = c.encode_texts(texts, turns)
            cols = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()),
                                             mask=texts.is_null() if texts.null_count else None)]
            if lossless:
                cols.append(pa.array(c.same(flat, ends, data, texts), pa.bool_()))
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=names)

    return docs.mapInArrow(run, schema).drop(copy)


def decode(rows: DataFrame, ids: str = "ids", text: str = "text", model: str = MODEL) -> DataFrame:
    """``rows`` plus the decoded text."""
    schema = T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model, 0.0, 0)
        for b in batches:
            texts = [None if x is None else c.decode(x) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=names)

    return rows.mapInArrow(run, schema)


def encoded_documents(docs: DataFrame, copies: bool = False) -> DataFrame:
    """(doc_id, ids, n_tokens, n_chars, lossless) of every document."""
    rows = encode(docs.select("doc_id", "text"), lossless="lossless", copies=copies)
    return rows.selectExpr("doc_id", "ids", "cast(coalesce(size(ids), 0) as long) as n_tokens",
                           "cast(coalesce(length(text), 0) as long) as n_chars", "lossless")


def op4_sentencepiece(spark: SparkSession, base: str) -> DataFrame:
    """All documents encoded with merge-dropout, each decoded again."""
    return encoded_documents(C.read(spark, base, "documents"))
