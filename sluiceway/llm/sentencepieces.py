"""SentencePiece ids of the merge type without a merge queue: backtracking over the longest pieces, and decoding.

The merges of a text never cross the border between two tokens exactly if they do not cross it when these two
tokens alone are merged again from their characters. So a row of tokens is the encoding of a text if all
neighbours are compatible in this sense, and there is one such row only. It is searched from the left: the
longest piece that fits its predecessor is taken, where none fits, the last token is given up for a shorter
one, and the position is marked as failed, since no other row of tokens can lead there.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept, slices

SPACE = "▁"
#: Distinct segments, and pairs of pieces, that a worker remembers; what comes later is worked out each time.
SEGMENTS, PAIRS = 700_000, 600_000
#: Characters whose matches are looked up at a time.
BLOCK = 4096
#: Rows that are decoded at a time.
_ROWS = 32
#: Longer segments are not remembered.
_LONG = 64


class PieceModel:
    """A model of the merge type with byte fallback, without user-defined pieces and with the identity normaliser."""

    def __init__(self, proto: bytes) -> None:
        import ahocorasick
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = library.vocab_size()
        self.pieces = [library.id_to_piece(i) for i in range(size)]
        byte = {self.pieces[i]: i for i in range(size) if library.is_byte(i)}
        special = [i for i in range(size) if library.is_control(i) or library.is_unknown(i)]
        if len(byte) != 256 or any(library.is_unused(i) for i in range(size)):
            raise ValueError("the model must have byte fallback and no unused pieces")
        probe = "a  ééﬁＡ \t"
        if library.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model must normalise by identity, with a space put in front")
        self.byte_ids = [byte[f"<0x{b:02X}>"] for b in range(256)]
        apart = {*byte.values(), *special}
        self.id_of = {p: i for i, p in enumerate(self.pieces) if i not in apart}
        self.rank = {p: -library.get_score(i) for p, i in self.id_of.items()}
        automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            automaton.add_word(piece, (len(piece), i))
        automaton.make_automaton()
        self._matches = automaton.iter
        self.longest = max(map(len, self.id_of), default=1)
        self._joined = {p[k : k + 2] for p in self.id_of for k in range(len(p) - 1)}
        self._cut = self._cutter()
        self._pairs: dict[int, bool] = {}
        self._histories: dict[str, list[tuple[float, str, str]]] = {}
        self._known: dict[str, list[int]] = {}
        control = {i for i in special if library.is_control(i)}
        texts = ["" if i in control else p.replace(SPACE, " ") for i, p in enumerate(self.pieces)]
        self._bytes = [t.encode() for t in texts]
        for b, i in enumerate(self.byte_ids):
            self._bytes[i] = bytes([b])
        for i in special:
            if i not in control:
                self._bytes[i] = library.decode([i]).encode()

    def _history(self, piece: str) -> list[tuple[float, str, str]]:
        """Merges of the piece's characters until none is left, best first and leftmost among equals.

        An entry has a merge's rank and the first and last part it meets; the last entry is the end.
        """
        known = self._histories.get(piece)
        if known is not None:
            return known
        parts, rank, steps = list(piece), self.rank, []
        ranks = [rank.get(x + y, math.inf) for x, y in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < math.inf:
            k = ranks.index(best)
            steps.append((best, parts[0], parts[-1]))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank.get(parts[k - 1] + parts[k], math.inf)
            if k < len(ranks):
                ranks[k] = rank.get(parts[k] + parts[k + 1], math.inf)
        steps.append((math.inf, parts[0], parts[-1]))
        if len(self._histories) < PAIRS:
            self._histories[piece] = steps
        return steps

    def fits(self, before: str, piece: str) -> bool:
        """Whether two tokens stay apart when they are merged again together; with none before, whether the piece is ever made."""
        after = self._history(piece)
        if after[-1][1] != piece:
            return False
        if not before:
            return True
        first, rank = self._history(before), self.rank
        i = j = 0
        while True:
            a, _, last = first[i]
            b, start, _ = after[j]
            across = rank.get(last + start, math.inf)
            # Of equal merges the left one comes first.
            if across < a and across <= b and across < math.inf:
                return False
            if a == b == math.inf:
                return True
            if a <= b:
                i += 1
            else:
                j += 1

    def _starts(self, text: str, block: int) -> list[list[tuple[int, int]]]:
        """(length, id) of the pieces that start at each position of a block, the longest last."""
        begin = block * BLOCK
        found: list[list[tuple[int, int]]] = [[] for _ in range(min(BLOCK, len(text) - begin))]
        if len(text) <= BLOCK:
            for end, match in self._matches(text):
                found[end - match[0] + 1].append(match)
        else:
            for end, match in self._matches(text[begin : begin + BLOCK + self.longest - 1]):
                at = end - match[0] + 1
                if at < BLOCK:
                    found[at].append(match)
        for at, here in enumerate(found):
            # A character that is no piece is a token by itself, to be spelt in bytes.
            if not here or here[0][0] != 1:
                here.insert(0, (1, -1))
        return found

    def segment(self, text: str) -> list[int]:
        """Ids of a normalised text."""
        whole = self.id_of.get(text)
        if whole is not None and self.fits("", text):
            return [whole]
        n, at, size = len(text), 0, len(self.pieces)
        failed, known = bytearray((n >> 3) + 1), self._pairs
        here, block = self._starts(text, 0), 0
        ends, ids, before, shorter_than = [0], [], size, self.longest + 1
        while at < n:
            if at // BLOCK != block:
                block = at // BLOCK
                here = self._starts(text, block)
            for length, i in reversed(here[at - block * BLOCK]):
                to = at + length
                if length >= shorter_than or failed[to >> 3] >> (to & 7) & 1:
                    continue
                pair = before * size + i
                fits = known.get(pair) if i >= 0 else None
                if fits is None:
                    fits = self.fits(text[ends[-2] : at] if ids else "", text[at:to])
                    if i >= 0 and before >= 0 and len(known) < PAIRS:
                        known[pair] = fits
                if fits:
                    ids.append(i)
                    ends.append(to)
                    at, before, shorter_than = to, i, self.longest + 1
                    break
            else:
                failed[at >> 3] |= 1 << (at & 7)
                ids.pop()
                shorter_than = ends.pop() - ends[-1]
                at, before = ends[-1], ids[-1] if ids else size
        if -1 not in ids:
            return ids
        spelt = ([i] if i >= 0 else [self.byte_ids[b] for b in text[x:y].encode()] for i, x, y in zip(ids, ends, ends[1:]))
        return list(chain.from_iterable(spelt))

    def _cutter(self) -> re.Pattern | None:
        """Cuts texts where no piece holds the two signs that meet: before spaces, and between signs of different classes."""
        if any(b == SPACE and a != SPACE for a, b in self._joined):
            return None
        # Signs of which a chain of pieces holds neighbours are one class.
        parent: dict[str, str] = {}

        def top(c: str) -> str:
            while parent.setdefault(c, c) != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        for a, b in self._joined:
            if a != SPACE and b != SPACE:
                parent[top(a)] = top(b)
        classes: dict[str, list[str]] = {}
        for c in parent:
            classes.setdefault(top(c), []).append(c)
        runs = "|".join(f"[{''.join(map(re.escape, sorted(c)))}]+" for c in sorted(classes.values(), key=len, reverse=True))
        return re.compile(f"{SPACE}*(?:{runs}|[^{SPACE}])|{SPACE}+", re.DOTALL)

    def _segments(self, text: str) -> list[str]:
        """``text`` cut where no merge can reach across."""
        if self._cut is not None:
            return self._cut.findall(text)
        cuts = [k for k in range(1, len(text)) if text[k - 1 : k + 1] not in self._joined]
        return [text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)])]

    def encode(self, text: str) -> list[int]:
        """Ids as the library gives them, without begin or end."""
        if not text:
            return []
        known, found = self._known, []
        for part in self._segments(SPACE + text.replace(" ", SPACE)):
            ids = known.get(part)
            if ids is None:
                ids = self.segment(part)
                if len(part) <= _LONG and len(known) < SEGMENTS:
                    known[part] = ids
            found.append(ids)
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> str:
        """The text of ids as the library gives it: the space in front goes, bytes that are no UTF-8 become U+FFFD."""
        if not ids:
            return ""
        shown = [self._bytes[i] for i in ids]
        # Bytes on both sides of a control piece make no character.
        cuts = [0, *(k for k, part in enumerate(shown) if not part), len(ids)] if b"" in shown else [0, len(ids)]
        whole = "".join(self._characters(b"".join(shown[i:j])) for i, j in zip(cuts, cuts[1:]))
        first = next((i for i in ids if self._bytes[i]), None)
        return whole[1:] if first is not None and self.pieces[first].startswith(SPACE) else whole

    @staticmethod
    def _characters(whole: bytes) -> str:
        """Each byte that starts no character becomes U+FFFD."""
        try:
            return whole.decode()
        except UnicodeDecodeError:
            pass
        out, at = [], 0
        while at < len(whole):
            for size in (1, 2, 3, 4):
                try:
                    out.append(whole[at : at + size].decode())
                except UnicodeDecodeError:
                    continue
                at += size
                break
            else:
                out.append("�")
                at += 1
        return "".join(out)


def _model(proto: bytes) -> PieceModel:
    return kept(("pieces", hash(proto)), lambda: PieceModel(proto))


def _shipped(df: DataFrame, model_path: str):
    # Half a megabyte or so, whatever the data; the executors need no file.
    with open(model_path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids) of every row of ``docs``: the ids of its whole text as the library would give them.

    A null text is an empty one and has no ids. Rows that repeat an id or a text are encoded each; a null id
    keeps its row. Other columns are ignored, whatever their names; an empty table gives no rows. Only
    segments are remembered from text to text, and of a segment only a few thousand characters are looked up at a time, so a long one without spaces
    needs little more than its ids.
    """
    proto = _shipped(docs, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(proto.value)
        for batch in slices(batches, "text"):
            ids = [model.encode(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("piece_id"), pa.array(ids, pa.list_(pa.int32()))], ["piece_id", "ids"])

    rows = docs.select(F.col(id_col).alias("piece_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["piece_id"]
    return rows.mapInArrow(run, f"piece_id {kind}, ids array<int>").withColumnRenamed("piece_id", id_col)


def decode_texts(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(``id_col``, ids, text) of every row of ``encoded``. Null ids are none; an id outside the model raises."""
    proto = _shipped(encoded, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(proto.value)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                lists = (row.values.to_numpy().tolist() if row.is_valid else [] for row in part.column("ids"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([model.decode(ids) for ids in lists], pa.string())], ["piece_id", "ids", "text"])

    rows = encoded.select(F.col(id_col).alias("piece_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    kind = dict(rows.dtypes)["piece_id"]
    return rows.mapInArrow(run, f"piece_id {kind}, ids array<int>, text string").withColumnRenamed("piece_id", id_col)
