"""Hashed character n-grams of words, and word scores that a worker computes once."""

from __future__ import annotations

import re
import zlib

import numpy as np

STRIP = bytes(x for x in range(128) if not chr(x).isalnum())
CACHED_WORDS = 400_000
LONG = 64  # bytes; a longer token is read in pieces
PIECE = 16  # characters that a piece moves on; it holds as many more as an n-gram can reach over its end
JOINTS = re.compile(r"[\s_\u200b\u2060\ufeff]+")
CHUNK = 16_384  # words whose n-grams are gathered at once


def pieces_of_long(words: list[bytes], most: int = 5) -> list[bytes]:
    """The words, with every token of over ``LONG`` bytes in parts: split at any white space of Unicode, zero-width space or
    underscore, and parts that are still long (scripts without spaces) in pieces that hold each of their n-grams of up to ``most`` characters."""
    if not words or max(map(len, words)) <= LONG:
        return words
    out: list[bytes] = []
    for w in words:
        if len(w) <= LONG:
            out.append(w)
            continue
        for part in filter(None, JOINTS.split(w.decode("utf-8", "replace"))):
            raw = part.encode("utf-8", "replace")
            if len(raw) <= LONG:
                out.append(raw)
            else:
                out += [part[a : a + PIECE + most - 1].encode("utf-8", "replace") for a in range(0, max(len(part) - most + 1, 1), PIECE)]
    return out


def normal(word: bytes) -> str:
    """A word as it is scored: lower case, without ASCII marks at its ends."""
    return word.strip(STRIP).decode("utf-8", "replace").lower()


def buckets(word: str, size: int, least: int = 3, most: int = 5) -> list[int]:
    """Buckets of all n-grams of ``<word>``; an empty word has none."""
    if not word:
        return []
    padded, crc = f"<{word}>", zlib.crc32
    if padded.isascii():
        raw = padded.encode()
        return [crc(raw[i : i + n]) % size for n in range(least, most + 1) for i in range(len(raw) - n + 1)]
    return [crc(padded[i : i + n].encode("utf-8", "replace")) % size for n in range(least, most + 1) for i in range(len(padded) - n + 1)]


class WordScores(dict):
    """The mean weight of a word's buckets, by its raw bytes; words that look alike once normalised are computed once. Both tables are bounded."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights.tolist()
        self.of_normal: dict[str, float] = {}

    def __missing__(self, word: bytes) -> float:
        plain = normal(word)
        got = self.of_normal.get(plain)
        if got is None:
            got = self.mean(plain)
            if len(self.of_normal) < CACHED_WORDS and len(plain) <= 64:
                self.of_normal[plain] = got
        if len(self) < CACHED_WORDS and len(word) <= 64:
            self[word] = got
        return got

    def mean(self, word: str) -> float:
        at, weights = buckets(word, len(self.weights)), self.weights
        return sum([weights[i] for i in at]) / len(at) if at else 0.0


class Bags:
    """Passages of words as bags of words, and words as bags of buckets, for training in numpy."""

    def __init__(self, vocabulary: list[str], word_of: np.ndarray, word_n: np.ndarray, size: int, passage: int):
        """``word_of`` numbers the words of all passages one after another, ``word_n`` counts each passage's; none is empty."""
        grams = [np.array(buckets(w, size) or [size], np.int32) for w in vocabulary]  # the last bucket stays 0
        self.word_of, self.word_at = word_of, _starts(word_n)
        self.word_by = np.maximum(word_n, passage).astype(np.float32)  # a passage of fewer words counts as so many
        self.passage_of_word = np.repeat(np.arange(len(word_n), dtype=np.int32), word_n)
        self.gram_of, self.gram_n = np.concatenate(grams), np.array(list(map(len, grams)))
        self.gram_at = _starts(self.gram_n)
        self.word_of_gram = np.repeat(np.arange(len(grams), dtype=np.int32), self.gram_n)
        self.size = size
        self.frequency = np.bincount(self.gram_of, np.bincount(word_of, minlength=len(grams))[self.word_of_gram], size + 1)

    def means(self, table: np.ndarray) -> np.ndarray:
        """For each passage the mean over its words of the mean of their buckets' rows in ``table``."""
        words = np.empty((len(self.gram_n), table.shape[1]), np.float32)
        ends = self.gram_at + self.gram_n
        for lo in range(0, len(words), CHUNK):
            hi = min(lo + CHUNK, len(words))
            rows = table[self.gram_of[self.gram_at[lo] : ends[hi - 1]]]
            words[lo:hi] = np.add.reduceat(rows, self.gram_at[lo:hi] - self.gram_at[lo], axis=0) / self.gram_n[lo:hi, None]
        return np.stack([np.add.reduceat(words[self.word_of, k], self.word_at) / self.word_by for k in range(table.shape[1])], axis=1)

    def slopes(self, of_passages: np.ndarray) -> np.ndarray:
        """The slopes of the buckets' rows, from those of the passages' means."""
        out = np.empty((self.size + 1, of_passages.shape[1]), np.float32)
        for k in range(of_passages.shape[1]):
            each = (of_passages[:, k] / self.word_by)[self.passage_of_word]
            words = np.bincount(self.word_of, each, len(self.gram_n)) / self.gram_n
            out[:, k] = np.bincount(self.gram_of, words[self.word_of_gram], self.size + 1)
        out[-1] = 0
        return out


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)


class Descent:
    """Gradient steps with momentum, each scaled so that the strongest slopes of a step move by ``rate``.

    A row's slope counts by ``1 / (sqrt(its frequency) + 1)``: what stands out from chance moves, what is just
    frequent does not.
    """

    def __init__(self, array: np.ndarray, rate: float, frequency: np.ndarray | None = None, share: float = 0.9999):
        self.array, self.rate, self.share = array, rate, share
        self.scale = 1.0 if frequency is None else (1 / (np.sqrt(frequency) + 1)).astype(array.dtype)[:, None]
        self.m = np.zeros_like(array)

    def step(self, slope: np.ndarray) -> None:
        self.m += 0.3 * (slope * self.scale - self.m)
        strong = np.quantile(np.abs(self.m), self.share)
        self.array -= self.rate * np.clip(self.m / (strong + 1e-12), -1, 1)
