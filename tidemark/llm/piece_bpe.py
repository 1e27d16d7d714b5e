"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A model's pieces become flat numpy arrays: a number for each symbol, and a hash table
from a pair of symbols to the merged symbol and its rank. Text is cut where no piece
can reach across (in front of a run of blanks, around line feeds), and the distinct
cuts of a batch are encoded together. Each round takes the segmented minimum of the
pair ranks of every word, merges its places from the left at the same time, and
compacts the arrays, until no pair remains.

Merging one pair at a time is the definition; places of the same rank may be merged
together only if no pair that a merge makes ranks as high. Where one does, that word
merges its leftmost place alone in this round, so the result is always exact.

Defined results: null text counts as empty; empty text has the end id alone and decodes
to an empty text. Characters outside the model become byte ids, or the unknown id if
the model has no byte pieces. Repeated rows are encoded each; columns named like a
result are replaced. Texts are worked off in slices, so a task holds one slice's cuts and
a bounded memory of cuts already encoded.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import schema_with, with_arrays

BLANK = "▁"
codecs.register_error("each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))
_NONE = np.iinfo(np.int32).max
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open-addressing table from a pair of symbols to (rank, merged symbol)."""

    def __init__(self, pairs: dict[int, tuple[int, int]]) -> None:
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, _NONE, np.int32)
        self.merged = np.zeros(1 << self.bits, np.int32)
        left = np.fromiter(pairs, np.int64, len(pairs))
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        slot = self._slot(left)
        while len(left):
            free = np.flatnonzero(self.keys[slot] == -1)
            _, first = np.unique(slot[free], return_index=True)
            took = free[first]
            self.keys[slot[took]] = left[took]
            self.rank[slot[took]], self.merged[slot[took]] = values[took, 0], values[took, 1]
            rest = np.ones(len(left), bool)
            rest[took] = False
            left, values, slot = left[rest], values[rest], (slot[rest] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = self._slot(key)
        seen = self.keys[slot]
        lost = np.flatnonzero((seen != key) & (seen != -1))
        while len(lost):
            slot[lost] = (slot[lost] + 1) & (len(self.keys) - 1)
            seen = self.keys[slot[lost]]
            lost = lost[(seen != key[lost]) & (seen != -1)]
        hit = self.keys[slot] == key
        return np.where(hit, self.rank[slot], _NONE), self.merged[slot]


class PieceModel:
    """The pieces of a SentencePiece BPE model file as arrays."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.vocab_size()
        self.end, self.unknown = lib.eos_id(), lib.unk_id()
        self.texts = [lib.id_to_piece(i) for i in range(size)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) for i in range(size)]
        byte = [lib.is_byte(i) for i in range(size)]
        self.byte_ids = {int(self.texts[i][3:5], 16): i for i in range(size) if byte[i]}
        #: What an id decodes to.
        self.bytes = [
            bytes([int(t[3:5], 16)]) if byte[i] else b"" if lib.is_control(i) else
            " ⁇ ".encode() if lib.is_unknown(i) else t.replace(BLANK, " ").encode()
            for i, t in enumerate(self.texts)
        ]
        normal = {t: i for i, t in enumerate(self.texts) if not special[i] and not byte[i]}
        chars = sorted({c for t in normal for c in t} - set(normal))
        self.symbols = size + len(chars)  # characters of pieces that are none themselves come last
        number = normal | {c: size + i for i, c in enumerate(chars)}
        self.width = self.symbols + 0x110000
        self.of_char = np.arange(self.symbols, self.width, dtype=np.int32)
        for text, i in number.items():
            if len(text) == 1:
                self.of_char[ord(text)] = i
        self.char_of = {i: ord(c) for c, i in number.items() if i >= size}
        self.size = size
        scores = {t: lib.get_score(i) for t, i in normal.items()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = {}
        for text, i in normal.items():
            for cut in range(1, len(text)):
                a, b = number.get(text[:cut]), number.get(text[cut:])
                if a is not None and b is not None:
                    pairs[a * self.width + b] = (order[scores[text]], i)
        self.pairs = PairTable(pairs)
        if any(BLANK in t.lstrip(BLANK) or "\n" in t for t in normal):
            raise ValueError("pieces reach across words or lines; their cuts would not be exact")

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.pairs.find(left.astype(np.int64) * self.width + right)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words in one array, and the offset of each word in it."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym, word = self.of_char[points], np.repeat(np.arange(len(words)), lengths)
        rank, into = self._all_ranks(sym, word)
        done_sym, done_word = [], []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(word)])
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            over = least == _NONE
            if over.any():
                done_sym.append(sym[over])
                done_word.append(word[over])
                open_ = ~over
                sym, word, rank, into, least = sym[open_], word[open_], rank[open_], into[open_], least[open_]
                if not len(sym):
                    break
            at = self._places(sym, word, rank, into, least)
            sym[at] = into[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            new = at - np.arange(len(at))  # each earlier merge took one place away
            sym, word = sym[keep], word[keep]
            # A pair is known by its left place; pairs beside a merged symbol are looked up anew.
            rank, into = rank[keep], into[keep]
            beside = np.zeros(len(sym), bool)
            beside[new] = True
            beside[new[new > 0] - 1] = True
            touched = np.flatnonzero(beside)
            rank[touched] = _NONE
            touched = touched[touched + 1 < len(sym)]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched], into[touched] = self._ranks(sym[touched], sym[touched + 1])
        sym, word = np.concatenate([*done_sym, sym]), np.concatenate([*done_word, word])
        by_word = np.argsort(word, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))])
        return sym[by_word], offsets

    def _all_ranks(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, into = np.full(len(sym), _NONE, np.int32), np.zeros(len(sym), np.int32)
        if len(sym) > 1:
            found, merged = self._ranks(sym[:-1], sym[1:])
            rank[:-1] = np.where(word[:-1] == word[1:], found, _NONE)
            into[:-1] = merged
        return rank, into

    def _places(self, sym, word, rank, into, least) -> np.ndarray:
        """Left places of this round's merges."""
        at = np.flatnonzero(rank == least)
        # In a row of overlapping places every other one, from the left.
        fresh = np.r_[True, np.diff(at) > 1]
        row = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - row) % 2 == 0]
        mine = word[at]
        first = np.r_[True, mine[1:] != mine[:-1]]
        several = ~first | np.r_[~first[1:], False]
        if several.any():
            many = at[several]
            r, made = rank[many], into[many]
            before = np.maximum(many - 1, 0)
            left = sym[before]
            follows = np.r_[False, many[1:] - many[:-1] == 2] & np.r_[False, word[many][1:] == word[many][:-1]]
            left = np.where(follows, np.r_[0, made[:-1]], left)  # the neighbour has just been merged
            inside = (many > 0) & (word[before] == word[many])
            bad = inside & (self._ranks(left, made)[0] <= r)
            after = np.minimum(many + 2, len(sym) - 1)
            inside = (many + 2 < len(sym)) & (word[after] == word[many])
            bad |= inside & (self._ranks(made, sym[after])[0] <= r)
            alone = np.unique(word[many[bad]])
            if len(alone):
                at = at[first | ~np.isin(mine, alone)]
        return at

    def ids_of(self, symbols: Iterable[int]) -> list[int]:
        out = []
        for s in symbols:
            if s < self.size:
                out.append(s)
            else:
                char = chr(self.char_of[s] if s < self.symbols else s - self.symbols)
                out += [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids: pieces joined, every broken byte as U+FFFD.

        A blank in front is taken off if the first piece that is no control id has it.
        """
        ids = [i for i in ids if self.bytes[i]]
        data = b"".join(self.bytes[i] for i in ids)
        if ids and self.texts[ids[0]].startswith(BLANK):
            data = data[1:]
        return data.decode(errors="each_byte")


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


_CUT = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")


def slices(text: str, size: int) -> Iterator[str]:
    """The normalised text in slices of about ``size`` characters that end where a cut ends."""
    if text:
        text = BLANK + text.replace(" ", BLANK)
    start = 0
    while start < len(text):
        end = start + size
        while end < len(text) and not (text[end] == BLANK and text[end - 1] != BLANK):
            end = text.find(BLANK, end + 1)
            if end < 0:
                end = len(text)
        yield text[start:end]
        start = end


class Encoder:
    """Encodes texts; remembers up to ``limit`` cuts."""

    def __init__(self, pieces: PieceModel, limit: int = 200_000, slice_chars: int = 500_000) -> None:
        self.pieces, self.limit, self.slice_chars = pieces, limit, slice_chars
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}
        self.names = [str(i) for i in range(pieces.size)]

    def learn(self, cuts: Iterable[str]) -> None:
        new = [c for c in cuts if c not in self.ids]
        if not new:
            return
        symbols, offsets = self.pieces.merge(new)
        outside = np.logical_or.reduceat(symbols >= self.pieces.size, offsets[:-1]).tolist()
        inside = np.minimum(symbols, self.pieces.size - 1).tolist()
        symbols, offsets = symbols.tolist(), offsets.tolist()
        names = [self.names[i] for i in inside]
        data = [self.pieces.bytes[i] for i in inside]
        for cut, a, b, odd in zip(new, offsets, offsets[1:], outside, strict=False):
            if odd:
                ids = self.pieces.ids_of(symbols[a:b])
                self.ids[cut] = " ".join([self.names[i] for i in ids])
                self.decoded[cut] = b"".join([self.pieces.bytes[i] for i in ids])
            else:
                self.ids[cut] = " ".join(names[a:b])
                self.decoded[cut] = b"".join(data[a:b])

    def encode(self, texts: list[str]) -> Iterator[tuple[list[str], bytes]]:
        """Per text the ids as joined decimals, slice by slice, and the decoded bytes."""
        pending: list[list[list[str]]] = []
        chars = 0

        def flush():
            if len(self.ids) > self.limit:
                self.ids.clear()
                self.decoded.clear()
            self.learn({c for parts in pending for cuts in parts for c in cuts})
            for parts in pending:
                yield ([" ".join(map(self.ids.__getitem__, cuts)) for cuts in parts],
                       b"".join([b"".join(map(self.decoded.__getitem__, cuts)) for cuts in parts]))
            pending.clear()

        for text in texts:
            if len(text) > self.slice_chars:  # alone, a slice at a time
                yield from flush()
                ids, decoded = [], []
                for part in slices(text, self.slice_chars):
                    pending.append([_CUT.findall(part)])
                    for found, data in flush():
                        ids += found
                        decoded.append(data)
                yield ids, b"".join(decoded)
                continue
            pending.append([_CUT.findall(part) for part in slices(text, self.slice_chars)])
            chars += len(text)
            if chars > self.slice_chars:
                yield from flush()
                chars = 0
        yield from flush()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(model(path))


def encode_documents(
    docs: DataFrame, model_path: str, text: str = "text", add_end: bool = True, with_ids: bool = False,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``ids``.

    The digests are of the decimal ids joined by a blank and of the decoded text.
    """
    fields = [T.StructField("n_tokens", T.LongType(), False), T.StructField("ids_sha256", T.StringType(), False),
              T.StructField("decoded_sha256", T.StringType(), False)]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(model_path)
        end = [str(work.pieces.end)] if add_end else []
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            counts, ids, decoded, lists = [], [], [], []
            for parts, data in work.encode([t or "" for t in texts]):
                parts = parts + end
                counts.append(sum(p.count(" ") + 1 for p in parts))
                joined = " ".join(parts)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                data = data[1:] if data[:1] == b" " else data
                decoded.append(hashlib.sha256(data.decode(errors="replace").encode()).hexdigest())
                if with_ids:
                    lists.append(np.array(joined.split(" "), dtype=np.int32) if joined else np.empty(0, np.int32))
            columns = [("n_tokens", pa.array(counts, pa.int64())), ("ids_sha256", pa.array(ids, pa.string())),
                       ("decoded_sha256", pa.array(decoded, pa.string()))]
            if with_ids:
                columns.append(("ids", pa.array(lists, pa.list_(pa.int32()))))
            yield with_arrays(batch, columns)

    return docs.mapInArrow(run, schema_with(docs, *fields))


def decode_documents(encoded: DataFrame, model_path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of each row's ids; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(model_path)
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            yield with_arrays(batch, [(name, pa.array([pieces.decode(r or []) for r in rows], pa.string()))])

    return encoded.mapInArrow(run, schema_with(encoded, T.StructField(name, T.StringType(), False)))
