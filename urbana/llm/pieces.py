"""SentencePiece BPE encoding by a table of each prefix's last token, and decoding.

The BPE encoding of a text is the one sequence in which every two neighbours are compatible: merged from
their characters, they come out as just these two. So the encoding of a prefix is known by its last token:
of the tokens that end there (found with an automaton over all pieces), exactly one is compatible with the last token
of the prefix before it. The ids are read off backwards. This takes time in proportion to the text,
however long its words are.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbana.llm.arrow import with_columns

SPACE = "▁"
CACHED_WORDS = 200_000  # words a worker keeps; words beyond are encoded each time they occur
CACHED_CHARS = 40
CACHED_PAIRS = 500_000


class Words(dict):
    """Encodings by word, filled as they are asked for, up to a bound."""

    def __init__(self, encode, most: int = CACHED_WORDS):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        got = self.encode(word)
        if len(self) < self.most and len(word) <= CACHED_CHARS:
            self[word] = got
        return got


class Pieces:
    """One SentencePiece BPE model with identity normalisation, a dummy prefix and byte fallback."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        n = sp.get_piece_size()
        self.byte_id = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.id_of = {sp.id_to_piece(i): i for i in range(n) if not special[i] and not sp.is_unused(i)}
        self.score = {p: sp.get_score(i) for p, i in self.id_of.items()}
        self.piece = {i: p for p, i in self.id_of.items()}
        self.chars = {c for c in self.id_of if len(c) == 1}
        if any(c not in self.chars for p in self.id_of for c in p):
            raise ValueError("a piece has a character that is no piece")
        self.bytes_of = [b""] * n
        for p, i in self.id_of.items():
            self.bytes_of[i] = p.replace(SPACE, " ").encode()
        for b, i in self.byte_id.items():
            self.bytes_of[i] = bytes([b])
        self.is_byte = [sp.is_byte(i) for i in range(n)]
        self.bytes_of[self.unknown] = " ⁇ ".encode()
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            if self.merge(p) == [p]:
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.compatible: dict[int, bool] = {}
        inner = [p for p in self.id_of if SPACE in p.lstrip(SPACE)]
        # A chunk is a run of spaces and what follows up to the next; characters that are no piece stand alone.
        self.chunk = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if "\n" not in self.chars else f"{SPACE}*[^{SPACE}]+|{SPACE}+") if not inner else re.compile("(?s).+")
        self.by_lines = "\n" not in self.chars and not inner
        self.newline = self.ids("\n") if self.by_lines else b""
        self.spaced = Words(lambda w: self.ids(SPACE + w))
        self.plain = Words(self.ids)
        for sample in ("a b", " a  b ", "\u00c5e\u0301 \uff21\n\tb", "", "x" * 40):  # what this class takes for granted of a model
            if np.frombuffer(self.encode(sample), "<u4").tolist() != sp.encode(sample):
                raise ValueError("not a BPE model with identity normalisation and a dummy prefix")

    def merge(self, text: str) -> list[str]:
        """BPE by its definition: the best-scored neighbours merge first, of equals the leftmost."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        key = left << 32 | right
        got = self.compatible.get(key)
        if got is None:
            a, b = self.piece[left], self.piece[right]
            got = self.merge(a + b) == [a, b]
            if len(self.compatible) < CACHED_PAIRS:
                self.compatible[key] = got
        return got

    def known(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces."""
        if text in self.id_of and len(text) == 1:
            return [self.id_of[text]]
        last = [0] * len(text)  # the last token of each prefix
        size = [0] * len(text)
        compatible = self.compatible
        for end, (token, n) in self.automaton.iter(text):
            if size[end]:
                continue
            start = end - n
            if start >= 0:
                before = last[start]
                ok = compatible.get(before << 32 | token)
                if ok is None:
                    ok = self.fits(before, token)
                if not ok:
                    continue
            last[end], size[end] = token, n
        out, at = [], len(text) - 1
        while at >= 0:
            out.append(last[at])
            at -= size[at]
        return out[::-1]

    def ids(self, chunk: str) -> bytes:
        """Ids of a chunk as little-endian unsigned 32-bit integers."""
        out, chars = [], self.chars
        if all(c in chars for c in chunk):
            out = self.known(chunk)
        else:
            at = 0
            for i, c in enumerate(chunk):
                if c not in chars:
                    if i > at:
                        out += self.known(chunk[at:i])
                    out += [self.byte_id.get(b, self.unknown) for b in c.encode()]
                    at = i + 1
            if at < len(chunk):
                out += self.known(chunk[at:])
        return np.array(out, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text, without begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.by_lines and text[0] != " " and "  " not in text and SPACE not in text:
            spaced, plain, out = self.spaced.__getitem__, self.plain.__getitem__, []
            for i, line in enumerate(text.split("\n")):
                words = line.split(" ")
                if i:
                    out.append(self.newline)
                    if words[0]:
                        out.append(plain(words[0]))
                    out += map(spaced, words[1:])
                else:
                    out += map(spaced, words)
            return b"".join(out)
        whole = SPACE + text.replace(" ", SPACE)
        plain = self.plain.__getitem__
        return b"".join(map(plain, self.chunk.findall(whole)))

    def decode(self, ids: list[int]) -> bytes:
        """The UTF-8 text of ids: control ids give nothing, the dummy prefix goes, bytes that are no UTF-8 become U+FFFD each."""
        table = self.bytes_of
        raw = b"".join(map(table.__getitem__, ids))
        first = next((i for i in ids if table[i]), None)
        if first is not None and self.piece.get(first, "").startswith(SPACE):
            raw = raw[1:]
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return _each(raw)


def _each(raw: bytes) -> bytes:
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out).encode()


@functools.lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids``: begin id, the ids of the whole text, end id, as little-endian unsigned 32-bit integers.

    Null texts are empty and get the begin and end ids alone. Texts of any length are encoded whole, one at a time: a task holds a text, its
    pieces and its ids. Repeated rows stay and get equal ids. Other columns pass through (one named ``ids`` is replaced); an empty table gives an empty result.
    """

    def compute(rows: list[bytes]) -> list[pa.Array]:
        model = load(path)
        begin, end = (np.array([i], "<u4").tobytes() for i in (model.begin, model.end))
        return [pa.array([begin + model.encode(t.decode()) + end for t in rows], pa.binary())]

    return with_columns(docs, text, "ids binary", compute, keep)


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids (null ids: empty), which replaces a column of that name.

    Ids of any number are decoded whole, one row at a time. Repeated rows stay; an empty table gives an empty result.
    """

    def compute(rows: list[bytes]) -> list[pa.Array]:
        model = load(path)
        return [pa.array([model.decode(np.frombuffer(x, "<u4").tolist()) for x in rows], pa.binary()).cast(pa.string())]

    return with_columns(encoded, ids, "decoded string", compute, keep)


def n_ids(ids: str = "ids"):
    return (F.octet_length(ids) / 4).cast("long")
