"""Token counts under a unigram model, with dynamic programming shared over a trie.

The distinct words of a batch form a trie. The best score of a prefix does not depend on
what follows, so each trie node is scored once, level by level over all words together, from
the scores of the nodes above it; a word's count is that of its last node.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.text import CodeTable, gram_codes, word_blocks

CACHED_WORDS = 300_000
_WORD_START = "▁"
_FEW = 8  # words left on a level: go on one by one


class Unigram:
    """Pieces with log-probabilities.

    The vocabulary file ranks its pieces but has no probabilities; Zipf's law gives them:
    the piece of rank r has probability in proportion to 1 / (r + 1). A character that is no
    piece counts as its UTF-8 bytes, each as likely as the rarest piece. Of equally likely
    segmentations the one with fewest tokens counts.
    """

    def __init__(self, pieces: list[str]):
        rank = np.arange(1, len(pieces) + 1, dtype=float)
        scores = -np.log(rank) - np.log((1 / rank).sum())
        self.byte_score = float(scores[-1]) if len(scores) else -1.0
        self.score = dict(zip(pieces, scores.tolist()))
        self.longest = max(map(len, pieces), default=1)
        points = [np.frombuffer(p.encode("utf-32-le"), "<u4") for p in pieces]
        codes = np.array([gram_codes(p, len(p))[0] for p in points], np.uint64)
        self.table = CodeTable(codes)
        self._scores = np.empty(len(self.table.codes))
        at, found = self.table.find(codes)
        self._scores[found] = scores[at]

    def count_one(self, word: str) -> int:
        """Tokens of one word, by plain dynamic programming."""
        text = _WORD_START + word
        best = [(0.0, 0)]
        for i in range(1, len(text) + 1):
            options = []
            for n in range(1, min(i, self.longest) + 1):
                s = self.score.get(text[i - n : i])
                if s is not None:
                    options.append((best[i - n][0] + s, -best[i - n][1] - 1))
            if text[i - 1] not in self.score:
                b = len(text[i - 1].encode("utf-8", "surrogatepass"))
                options.append((best[i - 1][0] + b * self.byte_score, -best[i - 1][1] - b))
            s, n = max(options)
            best.append((s, -n))
        return best[-1][1]

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each of some distinct words in ascending order."""
        out = np.zeros(len(words), np.int64)
        if not words:
            return out
        lengths = np.array([len(w) for w in words]) + 1
        flat = np.frombuffer("".join(_WORD_START + w for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
        begin = np.cumsum(lengths) - lengths
        span = self.longest
        # per node: scores and counts of the last ``span`` levels, newest first, and the
        # codes of the suffixes of each length before the final mixing
        score = np.full((1, span), -np.inf)
        score[0, 0] = 0.0
        tokens = np.zeros((1, span), np.int64)
        active, node = np.arange(len(words)), np.zeros(len(words), np.int64)
        depth = 0
        while len(active) > _FEW or depth < span:
            depth += 1
            chars = flat[begin[active] + depth - 1]
            new = np.ones(len(active), bool)
            new[1:] = (node[1:] != node[:-1]) | (chars[1:] != chars[:-1])
            rep = np.flatnonzero(new)
            parent = node[rep]
            node = np.cumsum(new) - 1
            score, tokens = self._level(flat, begin[active[rep]] + depth, depth, score[parent], tokens[parent])
            ended = lengths[active] == depth
            out[active[ended]] = tokens[node[ended], 0]
            active, node = active[~ended], node[~ended]
            if not len(active):
                return out
        for i in active:
            out[i] = self.count_one(words[i])
        return out

    def _level(self, flat, end, depth, score, tokens):
        """Scores of nodes whose text ends before ``end``, from those of their parents."""
        best = np.full(len(end), -np.inf)
        least = np.zeros(len(end), np.int64)
        for n in range(1, min(depth, self.longest) + 1):
            window = flat[end[:, None] + np.arange(-n, 0)].astype(np.uint64)
            at, found = self.table.find(_row_codes(window))
            if n == 1:
                unknown = np.ones(len(end), bool)
                unknown[at] = False
            s = score[at, n - 1] + self._scores[found]
            t = tokens[at, n - 1] + 1
            better = (s > best[at]) | ((s == best[at]) & (t < least[at]))
            best[at[better]], least[at[better]] = s[better], t[better]
        odd = np.flatnonzero(unknown)
        size = _utf8_size(flat[end[odd] - 1])
        s, t = score[odd, 0] + size * self.byte_score, tokens[odd, 0] + size
        better = (s > best[odd]) | ((s == best[odd]) & (t < least[odd]))
        best[odd[better]], least[odd[better]] = s[better], t[better]
        keep = self.longest - 1
        return np.column_stack([best, score[:, :keep]]), np.column_stack([least, tokens[:, :keep]])


def _row_codes(rows: np.ndarray) -> np.ndarray:
    """The code of each row of code points, as ``gram_codes`` has it."""
    n = rows.shape[1]
    return gram_codes(rows.reshape(-1), n)[::n]


def _utf8_size(points: np.ndarray) -> np.ndarray:
    return 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)


@lru_cache(maxsize=2)
def load(path: str) -> Unigram:
    """The pieces of a sentencepiece file, by rank, without its special and byte pieces."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(p.get_piece_size())
    return Unigram([p.id_to_piece(i) for i in ids if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))])


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of each row.

    Words are split at ASCII white space, their case is kept; each starts with the
    vocabulary's word mark. Null, empty and blank texts have no words and no tokens. Repeated
    rows are rows of their own; extra columns are ignored; an empty table gives no rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = load(vocabulary), {}
        for b in batches:
            texts = b.column(1).to_pylist()
            n_words, n_tokens = [], []
            for lo in range(0, len(texts), 512):
                part = texts[lo : lo + 512]
                new = {w for t in part if t for block in word_blocks(t, 0, lower=False) for w in block if w not in known}
                if len(known) + len(new) > CACHED_WORDS:
                    known.clear()
                    new = {w for t in part if t for block in word_blocks(t, 0, lower=False) for w in block}
                words = sorted((w.decode("utf-8", "surrogatepass"), w) for w in new)
                found = model.count([w for w, _ in words])
                known.update(zip((w for _, w in words), found.tolist()))
                for t in part:
                    n = total = 0
                    for block in word_blocks(t or "", 0, lower=False):
                        n += len(block)
                        total += sum(map(known.__getitem__, block))
                    n_words.append(n)
                    n_tokens.append(total)
            columns = [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_tokens"])

    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(count, "doc_id long, n_words long, n_tokens long")
