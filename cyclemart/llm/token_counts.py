"""Token counts of a unigram vocabulary by dynamic programming shared over a trie.

Words are pre-tokens (a word-start mark and the word). The distinct pre-tokens of a stretch of texts are
walked in sorted order, which is the depth-first order of their trie: what is on the path
from the root (best score and number of pieces of every prefix) is kept, and a
pre-token only adds the characters below the node where it leaves the one before. So
each shared prefix is scored once. Terminal counts are remembered for later stretches in a
table of bounded size; a text's count is the sum over its words.

Scores: the vocabulary files have ranks but no probabilities, so a piece has the logarithm of
Zipf's law of its rank. A character outside the vocabulary falls back to its UTF-8 bytes, one piece each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
#: Texts are taken in stretches of about so many bytes; the memory of words is emptied beyond so many.
STRETCH_BYTES = 4 << 20
REMEMBERED_WORDS = 1_500_000
#: Longer words are counted, but not remembered.
LONG_WORD = 128

_remembered: dict[int, dict[bytes, int]] = {}


@dataclass(frozen=True)
class Unigram:
    """``scores`` of pieces; ``fallback`` is the score of each byte of a character outside."""

    scores: dict[str, float]
    fallback: float

    @property
    def longest(self) -> int:
        return max(map(len, self.scores), default=1)


def zipf_vocabulary(model_file: str) -> Unigram:
    """The pieces of a sentencepiece file in rank order, scored by log(1 / (rank + 2.7)); 32,000 entries at most here."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = sum(1 / (rank + 2.7) for rank in range(len(pieces)))
    scores = {piece: math.log(1 / (rank + 2.7) / total) for rank, piece in enumerate(pieces)}
    return Unigram(scores, min(scores.values()) - 10.0)


def trie_counts(words: list[str], vocabulary: Unigram, longest: int) -> list[int]:
    """Pieces of the best segmentation of each word; ``words`` sorted and distinct. Ties: fewer pieces."""
    scores, fallback = vocabulary.scores, vocabulary.fallback
    best, pieces = [0.0], [0]  # by prefix length, along the path from the root
    last, counts = "", []
    for word in words:
        shared, end = 0, min(len(last), len(word))
        while shared < end and last[shared] == word[shared]:
            shared += 1
        del best[shared + 1:], pieces[shared + 1:]
        for i in range(shared + 1, len(word) + 1):
            n_bytes = len(word[i - 1].encode("utf-8", "surrogatepass"))
            top, number = best[i - 1] + fallback * n_bytes, pieces[i - 1] + n_bytes
            for j in range(max(0, i - longest), i):
                score = scores.get(word[j:i])
                if score is not None:
                    score += best[j]
                    if score > top or (score == top and pieces[j] + 1 < number):
                        top, number = score, pieces[j] + 1
            best.append(top)
            pieces.append(number)
        counts.append(pieces[-1])
        last = word
    return counts


def _counted(shared, text: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        longest = vocabulary.longest
        memory = _remembered.setdefault(hash((len(vocabulary.scores), vocabulary.fallback)), {})
        for batch in batches:
            place = batch.schema.get_field_index(text)
            n_words, n_tokens = [], []
            stretch, size = [], 0
            for value in batch.column(place):
                words = (value.as_py() or "").encode("utf-8", "surrogatepass").split()
                stretch.append(words)
                size += sum(map(len, words))
                if size >= STRETCH_BYTES:
                    _finish(stretch, memory, vocabulary, longest, n_words, n_tokens)
                    stretch, size = [], 0
            _finish(stretch, memory, vocabulary, longest, n_words, n_tokens)
            kept = [i for i in range(batch.num_columns) if i != place]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                [batch.schema.field(i).name for i in kept] + ["n_words", "n_tokens"],
            )

    return count


def _finish(stretch: list, memory: dict, vocabulary: Unigram, longest: int, n_words: list, n_tokens: list) -> None:
    if len(memory) > REMEMBERED_WORDS:
        memory.clear()
    new = set().union(*stretch) - memory.keys()
    spelled = sorted((MARK + w.decode("utf-8", "surrogatepass"), w) for w in new)
    found = dict(zip((w for _, w in spelled), trie_counts([s for s, _ in spelled], vocabulary, longest), strict=True))
    memory.update((w, n) for w, n in found.items() if len(w) <= LONG_WORD)
    long = {w: n for w, n in found.items() if len(w) > LONG_WORD}
    for words in stretch:
        n_words.append(len(words))
        n_tokens.append(sum(memory[w] if len(w) <= LONG_WORD else long[w] for w in words) if long else sum(map(memory.__getitem__, words)))


def token_counts(docs: DataFrame, vocabulary: Unigram, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_words and n_tokens; null and empty texts have none.

    Columns of ``docs`` called n_words or n_tokens are replaced. The vocabulary, a file of fixed
    size, is broadcast.
    """
    docs = docs.drop(*[c for c in ("n_words", "n_tokens") if c != text])
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != text)
    return docs.mapInArrow(_counted(shared, text), f"{kept}n_words long, n_tokens long")
