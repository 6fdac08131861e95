"""SentencePiece BPE encoding by backtracking, and decoding.

The encoder never runs merges over a text. An Aho-Corasick automaton over the vocabulary
finds the longest piece at each place; two adjacent pieces may stand side by side only if
merging their joined text gives just these two again; a bitfield remembers places from
which no valid rest was found, so that the search goes back over each place at most once.
A sequence whose neighbours are all compatible is the one that merging produces.

Pieces never hold a word mark after another character, so a text is encoded word by word
and the ids of recent words are kept in a bounded table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .tables import held, map_arrow, texts

MARK = "▁"
#: Words whose ids a worker keeps; the table is emptied when it is full.
KEPT_WORDS = 600_000
#: Piece pairs whose compatibility a worker keeps, likewise.
KEPT_PAIRS = 300_000
#: Longer words are not kept.
KEPT_LENGTH = 64
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def _safe_boundaries(pieces) -> str:
    """A pattern for places inside a word that no piece spans.

    Such a place lies between a letter or digit and an ASCII sign (or line end) that stands
    next to a letter or digit in no piece. No merge can cross it, so both sides are encoded
    apart.
    """
    after_letter, before_letter = set(), set()
    for piece in pieces:
        for a, b in zip(piece, piece[1:]):
            if a.isalnum() and not b.isalnum():
                after_letter.add(b)
            elif b.isalnum() and not a.isalnum():
                before_letter.add(a)
    signs = {c for c in map(chr, range(128)) if not c.isalnum() and c != " "}

    def one_of(chars: set[str]) -> str:
        return "[" + "".join(f"\\x{ord(c):02x}" for c in sorted(chars)) + "]"

    letter = r"[^\W_]"
    opens, closes = one_of(signs - after_letter), one_of(signs - before_letter)
    return f"(?<={letter})(?={opens})|(?<={closes})(?={letter})"


class PieceCodec:
    """Encoder and decoder for one BPE model file with byte fallback."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.unknown = model.unk_id()
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [self.unknown] * 256
        self.surface: list[bytes] = []
        self.is_byte: list[bool] = []
        self._trie = ahocorasick.Automaton()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            byte = model.is_byte(i)
            self.is_byte.append(byte)
            if byte:
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif model.is_control(i):
                self.surface.append(b"")
            elif model.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.surface.append(piece.replace(MARK, " ").encode())
                self.rank[piece] = model.get_score(i)
                self.ids[piece] = i
                self._trie.add_word(piece, len(piece))
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} crosses a word boundary")
        self._trie.make_automaton()
        self._most = max(map(len, self.ids))
        self._inner = re.compile(_safe_boundaries(self.rank))
        self._compatible: dict[tuple[str, str], bool] = {}
        self._words: dict[str, tuple[int, ...]] = {}
        self._prefixes: dict[str, str | None] = {}

    def merge(self, text: str) -> list[str]:
        """Plain merging of a short text: the best-ranked pair first, the leftmost on ties."""
        parts = list(text)
        rank = self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = rank.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _longest(self, word: str, at: int) -> str:
        """The longest piece at a place, or the character there."""
        ahead = word[at : at + self._most]
        size = self._trie.longest_prefix(ahead)
        while size > 1 and ahead[:size] not in self.ids:
            size -= 1
        return ahead[:size] if size else ahead[:1]

    def _may_follow(self, left: str, right: str) -> bool:
        """Whether merging the joined text gives just these two (or the right one alone)."""
        if len(self._compatible) >= KEPT_PAIRS:
            self._compatible.clear()
        known = self.merge(left + right) == ([left, right] if left else [right])
        self._compatible[left, right] = known
        return known

    def _shorter(self, piece: str) -> str | None:
        """The longest vocabulary piece that is a proper prefix of ``piece``."""
        found = self._prefixes.get(piece, piece)
        if found is piece:
            size = len(piece) - 1
            while size > 1 and piece[:size] not in self.ids:
                size -= 1
            found = piece[:size] or None
            self._prefixes[piece] = found
        return found

    def split(self, word: str) -> list[str]:
        """The pieces of a word; characters outside the vocabulary stand alone."""
        n = len(word)
        known = self._compatible.get
        failed = bytearray(n + 1)
        out: list[str] = []
        at, last = 0, ""
        piece: str | None = self._longest(word, 0)
        while at < n:
            while piece is not None:
                end = at + len(piece)
                if not failed[end]:
                    fits = known((last, piece))
                    if fits or fits is None and self._may_follow(last, piece):
                        break
                piece = self._shorter(piece)
            if piece is not None:
                out.append(piece)
                at, last = end, piece
                if at < n:
                    piece = self._longest(word, at)
                continue
            if not out:
                raise ValueError(f"no valid split of {word!r}")
            failed[at] = 1
            piece = self._shorter(out.pop())
            at -= len(last)
            last = out[-1] if out else ""
        return out

    def _word_ids(self, word: str) -> Sequence[int]:
        ids: list[int] = []
        parts = self._inner.split(word)
        if len(parts) > 1:
            for part in parts:
                found = self._words.get(part)
                ids += self._word_ids(part) if found is None else found
        else:
            for piece in self.split(word):
                known = self.ids.get(piece)
                if known is not None:
                    ids.append(known)
                else:
                    ids.extend(self.byte_ids[b] for b in piece.encode())
        if len(word) <= KEPT_LENGTH:
            if len(self._words) >= KEPT_WORDS:
                self._words.clear()
            self._words[word] = tuple(ids)
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text, as the library's ``encode`` gives them; nothing for an empty text."""
        if not text:
            return []
        ids: list[int] = []
        known = self._words.get
        for word in _WORD.findall(MARK + text.replace(" ", MARK)):
            found = known(word)
            ids += self._word_ids(word) if found is None else found
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids, as the library's ``decode`` gives it.

        Bytes that form no character become one replacement mark each, and the blank that
        encoding puts first is taken away.
        """
        joined = b"".join(map(self.surface.__getitem__, ids))
        if joined[:1] == b" " and self._first_blank(ids):
            joined = joined[1:]
        try:
            return joined.decode()
        except UnicodeDecodeError:
            return self._decode_broken(ids)

    def _decode_broken(self, ids: list[int]) -> str:
        out: list[str] = []
        run = bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + size]).decode())
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()

        for i in ids:
            if self.is_byte[i]:
                run += self.surface[i]
            else:
                flush()
                out.append(self.surface[i].decode())
        flush()
        text = "".join(out)
        return text[1:] if text[:1] == " " and self._first_blank(ids) else text

    def _first_blank(self, ids: list[int]) -> bool:
        """Whether the first id with a surface is a piece, and its blank that of encoding."""
        first = next(i for i in ids if self.surface[i])
        return not self.is_byte[first] and first != self.unknown


def codec(model_file: str) -> PieceCodec:
    """One codec per worker process and model, until the worker does other work."""
    return held(("codec", model_file), lambda: PieceCodec(model_file))


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """``doc_id``, ``ids`` of every text (null counts as empty). One row per input row."""

    def run(batches: Iterator[pa.RecordBatch]):
        own = codec(model_file)
        for batch in batches:
            yield batch["doc_id"], [own.encode(t) for t in batch["text"].to_pylist()]

    return map_arrow(texts(docs), run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """``doc_id``, ``text`` from ``ids``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]):
        own = codec(model_file)
        for batch in batches:
            yield batch["doc_id"], [own.decode(i) if i else "" for i in batch["ids"].to_pylist()]

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip_digest(docs: DataFrame, model_file: str) -> DataFrame:
    """Per input row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Encodes and decodes in one pass over the texts, without a shuffle. A null or empty text
    has no tokens and decodes to an empty text; repeated rows give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        own = codec(model_file)
        names = [str(i) for i in range(len(own.surface))]
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch["text"].to_pylist():
                ids = own.encode(text)
                counts.append(len(ids))
                listed = ",".join(map(names.__getitem__, ids))
                of_ids.append(hashlib.sha256(listed.encode()).hexdigest())
                back = own.decode(ids) if ids else ""
                of_text.append(hashlib.sha256(back.encode()).hexdigest())
            yield batch["doc_id"], counts, of_ids, of_text

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_arrow(texts(docs), run, schema)
