"""SentencePiece encoding and decoding by a merge-type prefix table.

For a merge (BPE) vocabulary every prefix of a string has one encoding, and its last token is
unique: of the tokens that end at a position (found by an automaton over the vocabulary), it is
the one whose pair with the last token of the prefix before it is stable, that is, merging the
two tokens' text alone gives these two tokens again. The table of last tokens is filled from
left to right and the ids are recovered backwards from the end.

A merge makes pieces only, so none spans two neighbouring characters that no piece holds side by
side (a letter and a comma, text and a following space mark). A text is split there and each
segment is encoded alone. Many texts are split at once; a segment that they repeat is looked up
once, and its ids are gathered from columns. A worker keeps a table of segments it has met,
bounded in number and in the length of a segment, and so in bytes. Characters
outside the vocabulary become byte pieces. Nothing is normalised except that a text that isn't
empty gets a leading space mark and spaces become marks.

Null texts are empty: they have the end id alone and decode to the empty string. Repeated rows
and null ids are encoded like any other. A text of any length is encoded whole. An empty table
gives no rows. Only the two named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspan.llm.arrow import texts

MARK = "▁"
#: Segments and pairs that a worker keeps.
HELD = 600_000
#: The longest segment that is kept.
LONGEST = 32
#: Bytes of text, and characters of one, that are looked at together; a longer text stays whole.
AT_ONCE = 4_000_000


class PieceVocabulary:
    """Pieces of a merge model, the automaton over them, and the segment tables."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.end = model.eos_id()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.bytes: list[int] = [0] * 256
        self.byte_of: dict[int, int] = {}
        self.silent: set[int] = set()
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.byte_of[i] = int(piece[3:5], 16)
            elif model.is_control(i) or model.is_unknown(i):
                self.silent.add(i)
            else:
                self.id[piece], self.rank[piece] = i, -model.get_score(i)
        self.surfaces = [
            bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.silent else piece.replace(MARK, " ").encode() for i, piece in enumerate(self.pieces)
        ]
        self.decimal = [f"{i} " for i in range(size)]
        pairs = {pair for piece in self.id for pair in zip(piece, piece[1:])}
        number = {c: k for k, c in enumerate(sorted({c for pair in pairs for c in pair}), 1)}
        # Numbers of the characters that have neighbours in pieces, 0 for others; which numbers a piece holds side by side.
        self.number = np.zeros(0x110000, np.uint16)
        self.side_by_side = np.zeros((len(number) + 1,) * 2, bool)
        for c, k in number.items():
            self.number[ord(c)] = k
        self.number[ord(" ")] = self.number[ord(MARK)]
        for a, b in pairs:
            self.side_by_side[number[a], number[b]] = True
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id.items():
            if self.merged(piece) == [piece]:  # a piece that merging never makes is never a token
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.segments: dict[str, tuple[str, int, bytes]] = {}
        self.older: dict[str, tuple[str, int, bytes]] = {}

    def merged(self, text: str) -> list[str]:
        """Plain merging of a short string: the best-ranked neighbours first, leftmost among equals."""
        parts, rank, none = list(text), self.rank.get, float("inf")
        ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != none:
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], none)
        return parts

    def stable(self, a: int, b: int) -> bool:
        """Whether merging the text of two neighbours leaves them as they are."""
        if len(self.pairs) >= HELD:
            self.pairs.clear()
        left, right = self.pieces[a], self.pieces[b]
        known = self.pairs[a << 20 | b] = self.merged(left + right) == [left, right]
        return known

    def ids(self, text: str) -> list[int]:
        """Ids of a segment: the table of last tokens from left to right, then backwards from the end.

        A place that no token ends at holds a character outside the vocabulary, which merges with
        nothing: any token may follow it, and it becomes byte pieces.
        """
        last = [-1] * (len(text) + 1)
        known = self.pairs.get
        for end, (token, length) in self.automaton.iter(text):
            at = end + 1
            if last[at] != -1:
                continue
            if at != length and (before := last[at - length]) != -1:
                fits = known(before << 20 | token)
                if not (self.stable(before, token) if fits is None else fits):
                    continue
            last[at] = token
        out, at = [], len(text)
        while at:
            if (token := last[at]) == -1:
                out += (self.bytes[b] for b in reversed(text[at - 1].encode()))
                at -= 1
            else:
                out.append(token)
                at -= len(self.pieces[token])
        return out[::-1]

    def segment(self, text: str) -> tuple[str, int, bytes]:
        """Decimal ids of a segment, each with a space, their number, and what they decode to.

        Segments met lately are kept in two tables of bounded size, of which the older is given up
        when the newer is full, so that common ones stay.
        """
        known = self.segments.get(text)
        if known is None:
            known = self.older.get(text)
            if known is None:
                ids = self.ids(text.replace(" ", MARK))
                known = "".join([self.decimal[i] for i in ids]), len(ids), self.surface(ids)
            if len(text) > LONGEST:
                return known
            if len(self.segments) >= HELD // 2:
                self.older, self.segments = self.segments, {}
            self.segments[text] = known
        return known

    def surface(self, ids: list[int]) -> bytes:
        return b"".join([self.surfaces[i] for i in ids])

    def split(self, rows: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """Segments of all texts, one text after the other, and the places where each text begins and the last ends."""
        whole = "".join([f" {t}" for t in rows if t])
        begins = np.cumsum([0, *(len(t) + 1 if t else 0 for t in rows)])
        first = np.zeros(len(whole) + 1, bool)
        first[begins] = True
        for a in range(0, len(whole), AT_ONCE):
            numbers = self.number[np.frombuffer(whole[a : a + AT_ONCE + 1].encode("utf-32-le"), "<u4")]
            first[a + 1 : a + len(numbers)] |= ~self.side_by_side[numbers[:-1], numbers[1:]]
        raw = whole.encode()
        characters = np.append((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80, True)
        cuts = characters.copy()
        cuts[characters] = first
        offsets = np.flatnonzero(cuts)
        segments = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(raw))
        return segments.dictionary_encode(), np.searchsorted(np.flatnonzero(first), begins)

    def encode(self, text: str) -> list[int]:
        """Ids of ``text`` with the end id."""
        return [*(i for s in self.split([text])[0].to_pylist() for i in self.ids(s.replace(" ", MARK))), self.end]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; the leading space mark is dropped."""
        return self.surface(ids).decode(errors="replace").removeprefix(" ")


_loaded: dict[str, PieceVocabulary] = {}


def vocabulary(path: str) -> PieceVocabulary:
    if path not in _loaded:
        _loaded[path] = PieceVocabulary(path)
    return _loaded[path]


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def gathered(values: pa.Array, codes: pa.Array, begins: np.ndarray) -> list[memoryview]:
    """The bytes that the ``codes`` of each text pick out of ``values``, joined."""
    picked = values.take(codes)
    ends = np.frombuffer(picked.buffers()[1], np.int64)[begins].tolist()
    joined = memoryview(picked.buffers()[2] or b"")
    return [joined[a:b] for a, b in zip(ends, ends[1:])]


def digest(*data: bytes | memoryview) -> str:
    found = hashlib.sha256()
    for part in data:
        found.update(part)
    return found.hexdigest()


def parts(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``most`` bytes of text together."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // most)) + 1).tolist(), len(ends)]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def piece_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model=piece_model, with_ids: bool = False) -> DataFrame:
    """One row per text: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``, ``decoded``).

    ``model`` gives the path of the model file on the machine that asks.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model())
        end = str(vocab.end).encode()
        for batch in (p for whole in batches for p in parts(whole, AT_ONCE)):
            found, begins = vocab.split(texts(batch.column(1)))
            known = [vocab.segments.get(s) or vocab.segment(s) for s in found.dictionary.to_pylist()]
            codes = found.indices
            decimals = gathered(pa.array([k[0] for k in known], pa.large_string()), codes, begins)
            surfaces = [s[s[:1] == b" " :] for s in gathered(pa.array([k[2] for k in known], pa.large_binary()), codes, begins)]
            sums = np.append(0, np.cumsum(np.array([k[1] for k in known], np.int64)[codes.to_numpy()]))
            out = {
                "doc_id": batch.column(0),
                "n_tokens": pa.array(np.diff(sums[begins]) + 1, pa.int64()),
                "ids_sha256": pa.array([digest(d, end) for d in decimals], pa.string()),
                "decoded_sha256": pa.array([digest(s) for s in surfaces], pa.string()),
            }
            if with_ids:
                ids = [[*map(int, bytes(d).split()), vocab.end] for d in decimals]
                out |= {"ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array([str(s, "utf-8") for s in surfaces], pa.string())}
            yield pa.RecordBatch.from_pydict(out)

    wanted = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return wanted.mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids)
