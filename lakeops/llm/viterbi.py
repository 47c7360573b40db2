"""Token counts of a unigram tokenizer, without building tokens (operator 6).

An Aho-Corasick automaton of the vocabulary finds every piece that ends at each character; the best
path to that character carries just its score and its number of pieces. Tie rules are those of the
unigram tokenizers in use: candidates come by growing start, the first of equals stays, and a
character that is no piece itself may stand alone at the lowest score minus 10. Such a character costs
one piece per UTF-8 byte where the vocabulary has byte pieces, else one.

No piece may continue over the start of a word, which the constructor verifies, nor contain a line
break; so best paths of words are parts of the best path of the text, and a bounded memory of word
results saves most of the work. Scores are sums of doubles in text order within a word; with
whole-number scores sums are exact, and the split cannot change a tie.

Edge cases: null and empty texts have 0 tokens. A word of any length is handled with memory for
one piece length. Repeated rows are counted each. Other columns are unused.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
_REMEMBERED = 400_000
_LONG = 48
_UNIT = re.compile(r" *[^ \n]+| +|\n")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with a space as word mark, their scores, and whether bytes stand in for the unknown."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_pieces: bool

    @staticmethod
    def load(path: str = DEFAULT_MODEL) -> Vocabulary:
        """The ordinary pieces of a sentencepiece model file, read on the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i))]
        return Vocabulary(
            tuple(model.id_to_piece(i).replace("▁", " ") for i in plain),
            tuple(float(model.get_score(i)) for i in plain),
            sum(model.is_byte(i) for i in ids) == 256,
        )


class Counter:
    """Counts pieces of texts; made once per task."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.machine = ahocorasick.Automaton()
        for piece, score in zip(vocabulary.pieces, vocabulary.scores):
            self.machine.add_word(piece, (len(piece), score))
        self.machine.make_automaton()
        self.single = {p for p in vocabulary.pieces if len(p) == 1}
        self.unknown = min(vocabulary.scores) - UNKNOWN_PENALTY
        self.byte_pieces = vocabulary.byte_pieces
        self.ring = max(map(len, vocabulary.pieces)) + 1
        inner = re.compile(r"[^ ] |\n")
        self.by_word = not any(inner.search(p) for p in vocabulary.pieces)
        self.known: dict[str, tuple[int, int]] = {}

    def unit(self, text: str) -> tuple[int, int]:
        """Pieces and unknown characters on the best path."""
        ring, unknown, single = self.ring, self.unknown, self.single
        score, count, odd = [0.0] * ring, [0] * ring, [0] * ring
        found = self.machine.iter(text)
        at, match = next(found, (-1, None))
        for i, char in enumerate(text):
            best, here = None, (i + 1) % ring
            while at == i:
                start = (i + 1 - match[0]) % ring
                value = score[start] + match[1]
                if best is None or value > best:
                    best, n, u = value, count[start] + 1, odd[start]
                at, match = next(found, (-1, None))
            if char not in single:
                start = i % ring
                value = score[start] + unknown
                if best is None or value > best:
                    best, n, u = value, count[start] + (len(char.encode("utf-8", "surrogatepass")) if self.byte_pieces else 1), odd[start] + 1
            score[here], count[here], odd[here] = best, n, u
        return count[len(text) % ring], odd[len(text) % ring]

    def text(self, text: str | None) -> tuple[int, int]:
        if not text:
            return 0, 0
        text = " " + text.replace("▁", " ")
        known, tokens, odd = self.known, 0, 0
        for unit in _UNIT.findall(text) if self.by_word else (text,):
            got = known.get(unit)
            if got is None:
                got = self.unit(unit)
                if len(unit) <= _LONG:
                    if len(known) >= _REMEMBERED:
                        known.clear()
                    known[unit] = got
            tokens += got[0]
            odd += got[1]
        return tokens, odd


def token_counts(docs: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, n_tokens, n_unknown (characters)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or Vocabulary.load())  # a vocabulary file: a few MB

    def task(batches):
        counter = Counter(shared.value)
        for batch in batches:
            out = np.zeros((batch.num_rows, 3), dtype=np.int64)
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                out[i] = (len(text or ""), *counter.text(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(out[:, j]) for j in range(3))], ["doc_id", "n_chars", "n_tokens", "n_unknown"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(task, f"doc_id {kind}, n_chars bigint, n_tokens bigint, n_unknown bigint")
