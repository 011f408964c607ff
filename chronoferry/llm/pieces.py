"""SentencePiece encoding and decoding by suffix-array matching."""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoferry.llm.common import chunks, columns_as, extended, prepare, quoted, strings

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Units of more characters are relaxed one by one with a heap instead of together in rounds.
LONG_UNIT = 64
CHUNK = 4 << 20
NONE = np.iinfo(np.int64).max
# Encoded units that a worker keeps for its next batch at most.
REMEMBERED = 200_000


class Pieces:
    """A byte-pair SentencePiece model as arrays: its pieces by text, ranks by score, byte pieces."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        processor = SentencePieceProcessor(model_proto=model)
        ids = range(processor.get_piece_size())
        names = [processor.id_to_piece(i) for i in ids]
        special = [processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i) for i in ids]
        scores = np.array([processor.get_score(i) for i in ids])
        if processor.encode("a  b ", out_type=str)[0][:1] != SPACE or "".join(
            processor.encode("a  b ", out_type=str)
        ) != f"{SPACE}a{SPACE * 2}b{SPACE}":
            raise ValueError("only models that keep white space and put one space in front are supported")
        self.forget()
        self.unknown = processor.unk_id()
        byte_ids = {names[i]: i for i in ids if processor.is_byte(i)}
        self.byte_ids = np.array([byte_ids.get(f"<0x{b:02X}>", -1) for b in range(256)])
        usable = [i for i in ids if not special[i] and not processor.is_unused(i) and names[i]]
        # Equal scores have equal ranks; the leftmost pair goes first then.
        rank = np.unique(-scores, return_inverse=True)[1]
        self.single = {names[i]: i for i in usable if len(names[i]) == 1}
        many = sorted((i for i in usable if len(names[i]) > 1), key=lambda i: names[i])
        self.piece_ids = np.array(many, np.int64)
        self.ranks = rank[self.piece_ids].astype(np.int64)
        self.texts = [names[i] for i in many]
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.longest = int(self.lengths.max(initial=1))
        # Where no piece goes on from another character into a space, a text can be cut before its spaces.
        # Likewise before line breaks, where they are in no piece.
        self.cuts_at_spaces = not any(re.search(f"[^{SPACE}]{SPACE}|\n", t) for t in self.texts)
        self.plain = [
            bytes([int(n[3:5], 16)]) if processor.is_byte(i) else b"" if processor.is_control(i)
            else " ⁇ ".encode() if processor.is_unknown(i) else n.replace(SPACE, " ").encode()
            for i, n in enumerate(names)
        ]

    # -- encoding ----------------------------------------------------------------------------

    def units(self, text: str) -> list[str]:
        """The text in parts that no piece crosses. A part stands for itself if it begins with a line break,
        else for itself with one more space in front."""
        if not text:
            return []
        text = text.replace(SPACE, " ")
        if not self.cuts_at_spaces:
            return [text]
        parts = text.replace("\n", " \n").split(" ")
        if "" in parts:
            parts = [u if u[0] == "\n" else u[1:] for u in re.findall(" +[^ \n]*|\n[^ \n]*", " " + text)]
        return parts

    def spelled(self, unit: str) -> str:
        """A unit as pieces spell it."""
        return (unit if self.cuts_at_spaces and unit[:1] == "\n" else SPACE + unit).replace(" ", SPACE)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as the model's own encoder gives them.

        Equal units are encoded once. Those that repeat are remembered for later calls, up to REMEMBERED.
        """
        parts = [self.units(text) for text in texts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        if not sizes.sum():
            return [np.empty(0, np.int32) for _ in texts]
        if len(self.known) > REMEMBERED:
            self.forget()
        units = list(chain.from_iterable(parts))
        old = len(self.known)
        at = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(at < 0)
        ids, ends = self.ids, self.ends
        if len(missing):
            rest = [units[k] for k in missing.tolist()]
            new = list(dict.fromkeys(rest))
            place = dict(zip(new, range(old, old + len(new))))
            at[missing] = np.fromiter(map(place.__getitem__, rest), np.int64, len(rest))
            more, more_ends = self.encode_units([self.spelled(u) for u in new])
            again = np.bincount(at[missing] - old) > 1
            ids, ends = np.concatenate([ids, more]), np.concatenate([ends, ends[-1] + more_ends])
            self.known |= zip([u for u, twice in zip(new, again.tolist()) if twice], range(old, old + int(again.sum())))
            many = np.diff(more_ends, prepend=0)
            self.ids = np.concatenate([self.ids, more[np.repeat(again, many)]])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(many[again])])
        many = (ends[1:] - ends[:-1])[at]
        last = np.cumsum(many)
        flat = ids[np.arange(last[-1]) - np.repeat(last - many - ends[at], many)]
        return np.split(flat, np.concatenate([[0], last])[np.cumsum(sizes)[:-1]])

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units, one after the other, and where each unit's end."""
        text = "\0".join(units) + "\0"
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        begins = np.cumsum(lengths + 1) - lengths - 1
        edge_keys, edge_pieces = self.edges(chars, begins, lengths)
        symbol_start, symbol_end = self.relax(lengths, begins, edge_keys, edge_pieces)
        return self.to_ids(text, chars, begins, lengths, symbol_start, symbol_end, edge_keys, edge_pieces)

    def edges(self, chars: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every occurrence of a piece: (start * (longest + 1) + length, sorted; the piece).

        The suffixes of the text are sorted by as many characters as the longest piece has, and a binary
        search finds the range of suffixes that each piece begins.
        """
        present = np.zeros(int(chars.max()) + 2, bool)
        present[chars] = True
        code_of = np.cumsum(present) * present  # 0 stands for the end of the text
        base = int(present.sum()) + 2
        deep = max(1, int(62 / np.log2(base)))  # characters that one number holds
        n = len(chars)
        codes = np.concatenate([code_of[chars], np.zeros(deep, np.int64)])
        first = np.zeros(n, np.int64)
        for k in range(deep):
            first = first * base + codes[k : k + n]
        first = np.concatenate([first, np.zeros(self.longest + deep, np.int64)])
        # Piece texts as codes; pieces with characters that the text doesn't have can't occur.
        joined = np.frombuffer("".join(self.texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        code = code_of[np.minimum(joined, len(code_of) - 1)]
        piece_starts = np.cumsum(self.lengths) - self.lengths
        piece = np.flatnonzero(np.minimum.reduceat(code, piece_starts) > 0) if len(joined) else np.empty(0, np.int64)
        rows = np.zeros((len(piece), self.longest + deep), np.int64)
        for k in range(self.longest):
            live = self.lengths[piece] > k
            rows[live, k] = code[piece_starts[piece[live]] + k]
        suffixes = np.argsort(first[:n], kind="stable")
        keys = first[suffixes]
        group, values = np.zeros(len(piece), np.int64), None
        found_starts, found_pieces = [], []
        depth = 0
        while len(piece):
            here = np.minimum(self.lengths[piece] - depth, deep)
            low_value = np.zeros(len(piece), np.int64)
            for k in range(deep):
                low_value = low_value * base + rows[:, depth + k]
            high_value = low_value + base ** (deep - here)
            if values is not None:  # among the suffixes of the piece's own group
                low_value = group * (len(values) + 1) + np.searchsorted(values, low_value)
                high_value = group * (len(values) + 1) + np.searchsorted(values, high_value)
            low, high = np.searchsorted(keys, low_value), np.searchsorted(keys, high_value)
            whole = (self.lengths[piece] <= depth + deep) & (low < high)
            found_starts.append(suffixes[ranges(low[whole], high[whole])])
            found_pieces.append(np.repeat(piece[whole], (high - low)[whole]))
            # Longer pieces go on among the suffixes that begin with what has been found of them.
            longer = (self.lengths[piece] > depth + deep) & (low < high)
            piece, rows, low, high = piece[longer], rows[longer], low[longer], high[longer]
            lows, at, group = np.unique(low, return_index=True, return_inverse=True)
            depth += deep
            sub = suffixes[ranges(lows, high[at])]
            values, follow = np.unique(first[sub + depth], return_inverse=True)
            pairs = np.repeat(np.arange(len(lows)), high[at] - lows) * (len(values) + 1) + follow
            order = np.argsort(pairs, kind="stable")
            suffixes, keys = sub[order], pairs[order]
        starts, pieces = np.concatenate([[], *found_starts]).astype(np.int64), np.concatenate([[], *found_pieces]).astype(np.int64)
        # Sorted by position; the piece rides along in the low bits.
        wide = max(1, len(self.texts).bit_length())
        both = np.sort(((starts * (self.longest + 1) + self.lengths[pieces]) << wide) | pieces)
        return both >> wide, both & ((1 << wide) - 1)

    def relax(
        self, lengths: np.ndarray, begins: np.ndarray, keys: np.ndarray, pieces: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the symbols when in every unit the best edge that joins two neighbours has
        been taken again and again: lowest rank first, leftmost first."""
        total = int(begins[-1] + lengths[-1]) + 1
        after = np.arange(1, total + 1)  # end of the symbol that starts here
        before = np.arange(-1, total - 1)  # start of the symbol in front
        unit = np.repeat(np.arange(len(lengths)), lengths + 1)[:total]
        last = (begins + lengths)[unit]
        head = begins[unit]

        def ranks(left: np.ndarray) -> np.ndarray:
            """Rank of joining the symbol that starts at `left` with the next one."""
            middle = after[left]
            out = np.full(len(left), NONE)
            inner = middle < last[left]
            size = after[np.minimum(middle, total - 1)] - left
            inner &= size <= self.longest
            key = left[inner] * (self.longest + 1) + size[inner]
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            if len(keys):
                out[inner] = np.where(keys[at] == key, self.ranks[pieces[at]], NONE)
            return out

        starts = np.flatnonzero(np.arange(total) != last)
        rank = np.full(total, NONE)
        rank[starts] = ranks(starts)
        alive = np.zeros(total, bool)
        alive[starts] = True
        for k in np.flatnonzero(lengths > LONG_UNIT).tolist():
            self.relax_long(int(begins[k]), int(begins[k] + lengths[k]), after, before, rank, alive, ranks)
        live = starts[(lengths <= LONG_UNIT)[unit[starts]]]
        while True:
            live = live[alive[live]]
            edges = np.flatnonzero(np.diff(unit[live], prepend=-1))
            if not len(edges):
                break
            best = np.minimum.reduceat(rank[live], edges)
            mark = rank[live] == np.repeat(best, np.diff(edges, append=len(live)))
            chosen = live[mark]
            chosen = chosen[(np.diff(unit[chosen], prepend=-1) != 0) & (rank[chosen] < NONE)]
            if not len(chosen):
                break
            gone = after[chosen]
            after[chosen] = after[gone]
            alive[gone] = False
            following = after[chosen]
            inner = following < last[chosen]
            before[following[inner]] = chosen[inner]
            rank[chosen] = ranks(chosen)
            led = chosen > head[chosen]
            front = before[chosen[led]]
            rank[front] = ranks(front)
            # Units without an edge left are done.
            open_units = np.zeros(len(lengths), bool)
            open_units[unit[chosen]] = True
            live = live[open_units[unit[live]]]
        symbols = np.flatnonzero(alive)
        return symbols, after[symbols]

    @staticmethod
    def relax_long(begin, end, after, before, rank, alive, ranks) -> None:
        """The same for one long unit, with a heap of edges."""
        heap = [(int(rank[k]), k) for k in range(begin, end) if rank[k] < NONE]
        heapq.heapify(heap)
        while heap:
            value, left = heapq.heappop(heap)
            if not alive[left] or rank[left] != value:
                continue
            gone = after[left]
            after[left] = after[gone]
            alive[gone] = False
            if after[left] < end:
                before[after[left]] = left
            for k in [left, int(before[left])] if left > begin else [left]:
                rank[k] = ranks(np.array([k]))[0]
                if rank[k] < NONE:
                    heapq.heappush(heap, (int(rank[k]), k))

    def to_ids(self, text, chars, begins, lengths, start, end, keys, pieces) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the symbols: pieces, single characters, or the bytes of characters without a piece."""
        size = end - start
        ids = np.full(len(start), -1, np.int64)
        one = size == 1
        alphabet, code = np.unique(chars[start[one]], return_inverse=True)
        ids[one] = np.array([self.single.get(chr(c), -1) for c in alphabet], np.int64)[code] if len(alphabet) else 0
        if (~one).any():
            ids[~one] = self.piece_ids[pieces[np.searchsorted(keys, start[~one] * (self.longest + 1) + size[~one])]]
        lost = np.flatnonzero(ids < 0)
        unit_end = np.searchsorted(start, begins + lengths)  # symbols before the end of each unit
        if not len(lost):
            return ids.astype(np.int32), unit_end
        if (self.byte_ids < 0).any():
            # Neighbouring unknown characters of a unit are one unknown token.
            again = np.zeros(len(ids), bool)
            again[lost] = True
            again[1:] &= (ids[:-1] < 0) & (start[1:] == end[:-1])
            again[0] = False
            ids[lost] = self.unknown
            return ids[~again].astype(np.int32), unit_end - np.concatenate([[0], np.cumsum(again)])[unit_end]
        encoded = [chr(c).encode() for c in chars[start[lost]].tolist()]
        many = np.ones(len(ids), np.int64)
        many[lost] = [len(e) for e in encoded]
        out = np.repeat(ids, many)
        out[out < 0] = self.byte_ids[np.frombuffer(b"".join(encoded), np.uint8)]
        return out.astype(np.int32), np.concatenate([[0], np.cumsum(many)])[unit_end]

    # -- decoding ----------------------------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        text = b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    many = high - low
    ends = np.cumsum(many)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many - low, many)


_LOADED: dict[bytes, Pieces] = {}


def loaded(model: bytes) -> Pieces:
    """The model of these bytes; a Python worker builds it once."""
    if model not in _LOADED:
        _LOADED[model] = Pieces(model)
    return _LOADED[model]


def read_model(path: str = DEFAULT_MODEL) -> bytes:
    with open(os.fspath(path), "rb") as file:
        return file.read()


def encode(docs: DataFrame, text_col: str = "text", model_path: str = DEFAULT_MODEL, name: str = "ids") -> DataFrame:
    """`docs` with the ids of its text as column `name` (array of int).

    Null and empty texts have no ids. Bytes that are no UTF-8 count as replacement characters. A column that
    has that name already is replaced. Rows are independent: an empty table stays empty, repeated rows repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    return extended(
        docs, text_col, name, "array<int>", lambda text: lists(loaded(shared.value).encode(strings(text))), CHUNK
    )


def lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *parts])))


def decode(rows: DataFrame, ids_col: str = "ids", model_path: str = DEFAULT_MODEL, name: str = "decoded") -> DataFrame:
    """`rows` with the text of its ids as column `name`; null ids have a null text, no ids an empty one.

    Null entries among the ids are left out. An id beyond the model is an error.
    """
    prepare(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(read_model(model_path))
    kept = [c for c in rows.columns if c.lower() != name.lower()]
    packed = rows.select(F.struct(*[F.col(quoted(c)) for c in kept]).alias("row"), F.col(quoted(ids_col)).alias("ids"))
    schema = T.StructType([packed.schema["row"], T.StructField("made", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(shared.value)
        for batch in batches:
            texts = [
                None if ids is None else pieces.decode([i for i in ids if i is not None])
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "made"])

    return packed.mapInArrow(run, schema).select("row.*", F.col("made").alias(name))


def coded(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = DEFAULT_MODEL
) -> DataFrame:
    """(id, ids, n_tokens, decoded, exact): the text encoded and decoded again, in one pass.

    exact says that decoding gives the text back; a text that has the model's own sign for a space does
    not come back, since the model writes both alike. Null texts count as empty.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    rows = columns_as(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(shared.value)
        for part in chunks(batches, "text", CHUNK):
            texts = strings(part.column("text"))
            parts = pieces.encode(texts)
            back = [pieces.decode(p.tolist()) for p in parts]
            exact = [b == t for b, t in zip(back, texts)]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), lists(parts), pa.array([len(p) for p in parts], pa.int32()), pa.array(back), pa.array(exact)],
                ["id", "ids", "n_tokens", "decoded", "exact"],
            )

    schema = f"id {kind.simpleString()}, ids array<int>, n_tokens int, decoded string, exact boolean"
    return rows.mapInArrow(run, schema)


def digest(rows: DataFrame) -> DataFrame:
    """What a query shows of `coded` rows: counts and checksums instead of the texts."""
    return rows.select(
        F.col("id").alias("doc_id"),
        F.col("n_tokens").cast("long").alias("n_tokens"),
        "ids",
        F.crc32("decoded").alias("decoded_crc32"),
        "exact",
    )
