"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a byte string has one encoding, hence one last token.  Storing that token per prefix is
enough: the encoding of a prefix is its last token after the encoding of what lies before it.  The
last token of a longer prefix is the one vocabulary string ending there that byte-pair merging keeps
apart from the last token before it; whether two neighbours stay apart depends on them alone and is
answered by undoing their merges from the border outwards.  So a string is encoded from left to right
in time proportional to its length, bytes can be appended, and after an edit work starts at the edit
and ends where the stored tokens agree again.

A text is cut by a pattern first and its pieces are encoded singly, as the library does; a piece that
is itself in the vocabulary is that token.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ship

KEPT = 500_000  # pieces a worker remembers
LONGEST_KEPT = 64
APART_KEPT = 2_000_000  # pairs whose answer is remembered
TOGETHER = 1 << 21  # characters of texts that learn their new pieces together
OUT_BYTES = 1 << 25  # size at which a worker hands decoded rows on


class _Lengths(dict):
    def __missing__(self, end: bytes) -> tuple[int, ...]:
        return (1,)


class Vocabulary:
    """Ranks, and how each token is made: ``left`` and ``right`` halves of its last merge, -1 for single bytes.

    A vocabulary string that merging never produces has no halves; it can only be a whole piece.  Ranks
    must follow the merges, as those of trained vocabularies do: no token before its parts.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if sorted(ranks.get(bytes([b]), -1) for b in range(256)) != list(range(256)) or sorted(ranks.values()) != list(range(len(ranks))):
            raise ValueError("ranks must be 0 to n, the single bytes first")
        self.ranks = ranks
        self.tokens = sorted(ranks, key=ranks.__getitem__)
        self.longest = max(map(len, ranks))
        self.left, self.right = [-1] * len(ranks), [-1] * len(ranks)
        self.merged: dict[tuple[int, int], int] = {}
        self.made = {bytes([b]): ranks[bytes([b])] for b in range(256)}  # what merging can produce
        self._apart: dict[int, bool] = {}
        for token in self.tokens[256:]:
            for cut in range(1, len(token)):
                a, b = self.made.get(token[:cut]), self.made.get(token[cut:])
                if a is not None and b is not None and self._stay_apart(a, b):
                    rank = ranks[token]
                    self.left[rank], self.right[rank], self.merged[a, b], self.made[token] = a, b, rank, rank
                    break
            else:
                if self._reached(token):
                    raise ValueError("a token ranks before the parts it is merged from")
        # By the last two bytes, how long tokens ending in them are, the longest first.
        ends: dict[bytes, set[int]] = {}
        for token in self.made:
            ends.setdefault(token[-2:], set()).add(len(token))
        self.lengths = _Lengths({end: tuple(sorted({1, *found}, reverse=True)) for end, found in ends.items()})

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})

    def _reached(self, token: bytes) -> bool:
        """Whether merging any vocabulary strings, the least rank first, makes a string whole."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, len(self.ranks)) for a, b in zip(parts, parts[1:])]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == len(self.ranks):
                return False
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return True

    def _stay_apart(self, a: int, b: int) -> bool:
        merged, left, right = self.merged.get, self.left, self.right
        before = len(left)  # only merges that come before this rank can still cross the border
        while True:
            crossing = merged((a, b))
            if crossing is not None and crossing < before:
                return False
            if a > b:  # the left neighbour was completed later: look at the border before that
                before, a = a, right[a]
                if a < 0:
                    return True
            else:  # equal merges run from the left, so one crossing with the same rank comes first
                before, b = b + 1, left[b]
                if b < 0:
                    return True

    def apart(self, a: int, b: int) -> bool:
        """Whether merging the bytes of two tokens gives these two tokens again."""
        known, pair = self._apart, a << 32 | b
        answer = known.get(pair)
        if answer is None:
            if len(known) >= APART_KEPT:
                known.clear()
            answer = known[pair] = self._stay_apart(a, b)
        return answer

    def extend(self, data: bytes, last: list[int], upto: int | None = None) -> None:
        """Add to ``last``, the last tokens of the prefixes of ``data`` known so far, those of the longer ones."""
        made, known, ask, lengths = self.made.get, self._apart.get, self.apart, self.lengths
        for end in range(len(last) + 1, (len(data) if upto is None else upto) + 1):
            for length in lengths[data[max(0, end - 2):end]]:
                if length > end:
                    continue
                token = made(data[end - length:end])
                if token is not None:
                    if length == end:
                        last.append(token)
                        break
                    before = last[end - length - 1]
                    apart = known(before << 32 | token)
                    if apart or apart is None and ask(before, token):
                        last.append(token)
                        break

    def walk_back(self, last: list[int], upto: int) -> list[int]:
        """Encoding of the prefix of ``upto`` bytes."""
        ids = []
        while upto:
            ids.append(last[upto - 1])
            upto -= len(self.tokens[ids[-1]])
        return ids[::-1]

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(data, last)
        return self.walk_back(last, len(data))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixTokens:
    """Bytes with the last token of each of their prefixes: exact encodings under appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self.last)

    def ids(self, upto: int | None = None) -> list[int]:
        """Encoding of the first ``upto`` bytes, by merging alone."""
        return self.vocabulary.walk_back(self.last, len(self.data) if upto is None else upto)

    def replace(self, begin: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of bytes begin ≤ p < end; returns how many prefixes were encoded anew.

        A prefix's token hangs on the bytes and tokens of the longest token's length before it.  Where as many
        prefixes in a row behind the edit have their old tokens, all later ones keep theirs.
        """
        rest = self.last[end:]
        data, last, window = self.data[:begin] + new + self.data[end:], self.last[:begin], self.vocabulary.longest
        fresh, agree = begin + len(new), 0
        self.vocabulary.extend(data, last, fresh)
        while len(last) < len(data) and agree < window:
            self.vocabulary.extend(data, last, len(last) + 1)
            agree = agree + 1 if last[-1] == rest[len(last) - 1 - fresh] else 0
        computed = len(last) - begin
        last += rest[len(last) - fresh:]
        self.data, self.last = data, last
        return computed


class TextEncoder:
    """Ids of whole texts for one vocabulary file and pattern, equal to the library's."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.vocabulary, self.pattern = Vocabulary.load(path), pattern
        self.split = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}
        self.agreed: set[str] = set()
        self.other: set[str] = set()
        self._library = None

    def _probe(self, chars: set[str]) -> None:
        """Sort characters by whether the library's pattern engine splits around them as ours does (Unicode tables differ)."""
        import tiktoken

        probes = {c: (f"a{c}1", f" {c}!", f"1{c}a") for c in chars}
        parts = {p[i:j].encode() for some in probes.values() for p in some for i in range(3) for j in range(i + 1, 4)}
        ranks = {bytes([b]): b for b in range(256)}
        ranks.update((part, 256 + i) for i, part in enumerate(sorted(parts - ranks.keys())))
        toy = tiktoken.Encoding("probe", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        for c, some in probes.items():
            same = all(toy.decode_tokens_bytes(toy.encode_ordinary(p)) == [m.encode() for m in self.split.findall(p)] for p in some)
            (self.agreed if same else self.other).add(c)

    def _by_library(self, text: str) -> list[int]:
        if self._library is None:
            import tiktoken

            self._library = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.vocabulary.ranks, special_tokens={})
        return self._library.encode_ordinary(text)

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pieces in order, each from where it parts from the one before."""
        vocabulary, data, last = self.vocabulary, b"", []
        for new in sorted(piece.encode() for piece in pieces):
            whole = vocabulary.ranks.get(new)
            if whole is None:
                same = 0
                for a, b in zip(data, new):
                    if a != b:
                        break
                    same += 1
                del last[same:]
                vocabulary.extend(new, last)
                data, ids = new, vocabulary.walk_back(last, len(new))
                self.pieces[new.decode()] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                self.pieces[new.decode()] = struct.pack("<I", whole)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; texts of one call learn their new pieces together."""
        out: list[bytes | None] = [None] * len(texts)
        split: list[tuple[int, list[str]]] = []
        for i, text in enumerate(texts):
            chars = set(text or "")
            unknown = chars - self.agreed - self.other
            if unknown:
                self._probe(unknown)
            if chars.isdisjoint(self.other):
                split.append((i, self.split.findall(text or "")))
            else:
                ids = self._by_library(text)
                out[i] = struct.pack(f"<{len(ids)}I", *ids)
        new = {piece for _, found in split for piece in found if piece not in self.pieces}
        self._learn(new)
        for i, found in split:
            out[i] = b"".join(map(self.pieces.__getitem__, found))
        for piece in new:
            if len(piece) > LONGEST_KEPT:
                del self.pieces[piece]
        if len(self.pieces) > KEPT:
            for piece in list(self.pieces)[:KEPT // 2]:  # the older half goes
                del self.pieces[piece]
        return out


class EditedText:
    """A text with the prefix tokens of its pieces, encoded again only near an edit.

    Characters on which pattern engines disagree are not looked for here; texts holding one are
    encoded whole by :class:`TextEncoder`.
    """

    def __init__(self, encoder: TextEncoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.starts: list[int] = []
        self.pieces: list[PrefixTokens] = []
        self.replace(0, 0, text)

    def ids(self) -> list[int]:
        ranks, out = self.encoder.vocabulary.ranks, []
        for piece in self.pieces:
            whole = ranks.get(piece.data)
            out += [whole] if whole is not None else piece.ids()
        return out

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, begin: int, end: int, new: str) -> int:
        """Put ``new`` in place of characters begin ≤ p < end; returns how many pieces were made anew.

        The pattern looks at most one character past a piece's successor, so pieces with two whole
        ones between them and the edit stay.  Behind the edit, the first piece that starts where an
        old one started ends the work: from there the text, and so every match, is the old one.
        """
        text, shift = self.text[:begin] + new + self.text[end:], len(new) - (end - begin)
        bounds = [*self.starts, len(self.text)]
        keep = max(0, sum(b <= begin for b in bounds[1:]) - 2)
        old = {s + shift: i for i, s in enumerate(self.starts) if s >= end}
        starts, pieces = self.starts[:keep], self.pieces[:keep]
        at, made = (bounds[keep] if keep < len(bounds) else 0), 0
        while at < len(text):
            same = old.get(at) if at >= begin + len(new) else None
            if same is not None:
                starts += [s + shift for s in self.starts[same:]]
                pieces += self.pieces[same:]
                break
            match = self.encoder.split.match(text, at)
            data, previous = match[0].encode(), self.pieces[len(pieces)] if len(pieces) < len(self.pieces) else None
            starts.append(at)
            if previous is not None and previous.data == data:
                pieces.append(previous)
            elif previous is not None and data.startswith(previous.data) and previous.data:
                grown = PrefixTokens(self.encoder.vocabulary)
                grown.data, grown.last = previous.data, list(previous.last)
                grown.append(data[len(previous.data):])
                pieces.append(grown)
                made += 1
            else:
                pieces.append(PrefixTokens(self.encoder.vocabulary, data))
                made += 1
            at = match.end()
        self.text, self.starts, self.pieces = text, starts, pieces
        return made


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(path, pattern)


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary.load(path)


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids): per row the ids of its whole text, little-endian unsigned 32-bit integers in one binary.

    Equal to the tiktoken library with the ranks at ``path`` (which executors must be able to read)
    and ``pattern``, without special tokens.  Null and empty texts have no ids; repeated rows stay
    repeated; other columns are ignored; an empty table gives an empty result.
    """
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            keys, texts, size, begin = batch.column(0), [], 0, 0
            for at, value in enumerate(batch.column(1), start=1):
                texts.append(value.as_py())
                size += len(texts[-1] or "")
                if size >= TOGETHER or at == batch.num_rows:
                    out = encoder.encode(texts)
                    counts = pa.array([len(one) // 4 for one in out], pa.int64())
                    yield pa.RecordBatch.from_arrays([keys.slice(begin, at - begin), counts, pa.array(out, pa.binary())], [key, "n_tokens", "ids"])
                    texts, size, begin = [], 0, at

    return df.select(key, F.col(text).alias("_text")).mapInArrow(work, f"`{key}` {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the bytes its ids stand for; null ids stand for none.  Ids outside the vocabulary end the job."""
    ship(encoded.sparkSession)
    names = encoded.columns
    place = names.index(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            done, size, begin = [], 0, 0
            for at, value in enumerate(batch.column(place), start=1):
                raw = value.as_py() or b""
                done.append(vocabulary.decode(np.frombuffer(raw, "<u4").tolist()))
                size += len(raw) + len(done[-1])
                if size >= OUT_BYTES or at == batch.num_rows:
                    kept = batch.slice(begin, at - begin)
                    yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(done, pa.binary())], [*names, out])
                    done, size, begin = [], 0, at

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema]
    return encoded.mapInArrow(work, ", ".join([*fields, f"`{out}` binary"]))


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded again."""
    return decode(encode(df, path, pattern, key, text), path).select(
        key, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
