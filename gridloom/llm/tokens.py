"""Token counts of a unigram tokenizer without building the tokens.

An Aho-Corasick automaton enumerates the vocabulary's matches by their end; dynamic programming over the ends carries
the best score and its number of pieces. Ties go as in the tokenizer: of equal scores the longest last piece wins, and
a character outside the vocabulary wins only with a strictly better score. Where no piece spans a word's start, the
best segmentation splits there, so distinct words are counted once per worker and looked up afterwards.

Defined results. Null and empty text: 0 tokens. Blank text: the tokens of its spaces. Repeated rows: equal counts. Very
long texts: memory for the dynamic programme is that of the longest word. Empty table: empty result. Extra columns are
dropped, but those of `keep`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import map_batches

SPACE = "▁"
#: Words that a worker remembers; beyond it the memory starts anew, which changes no count.
REMEMBER = 300_000


@dataclass(frozen=True)
class UnigramVocabulary:
    """Pieces with scores, in the tokenizer's order. fallback: characters outside become one piece for each UTF-8 byte."""

    pieces: tuple[tuple[str, float], ...]
    lowest: float
    fallback: bool = True
    prefix: bool = True


def load_vocabulary(path: str) -> UnigramVocabulary:
    """Read a sentencepiece model; its control, unknown and byte pieces never match text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    normal = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    lowest = min(model.get_score(i) for i in ids)
    return UnigramVocabulary(tuple((model.id_to_piece(i), model.get_score(i)) for i in normal), lowest, any(model.is_byte(i) for i in ids))


class UnigramCounter:
    def __init__(self, vocabulary: UnigramVocabulary):
        import ahocorasick

        self.v = vocabulary
        self.unknown = vocabulary.lowest - 10.0
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in vocabulary.pieces if len(p) == 1}
        self.memory: dict[str, int] = {}
        inside = any(SPACE in p.lstrip(SPACE) for p, _ in vocabulary.pieces)
        alone = "\n" if vocabulary.fallback and not any("\n" in p for p, _ in vocabulary.pieces) else ""
        self.words = re.compile(".+" if inside else f"{alone or '(?!)'}|{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+", re.S)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        line = (SPACE if self.v.prefix else "") + text.replace(" ", SPACE)
        memory, total = self.memory, 0
        for word in self.words.findall(line):
            n = memory.get(word)
            if n is None:
                n = self.viterbi(word)
                if len(memory) >= REMEMBER:
                    memory.clear()
                if len(word) <= 64:
                    memory[word] = n
            total += n
        return total

    def viterbi(self, line: str) -> int:
        """Pieces on the best path through line."""
        best = [-np.inf] * (len(line) + 1)
        pieces = [0] * (len(line) + 1)
        outside = [False] * (len(line) + 1)
        best[0] = 0.0
        ready = 0  # ends up to here are final

        def close(to: int) -> None:
            nonlocal ready
            while ready < to:
                at, char = ready, line[ready]
                ready += 1
                if char not in self.single and (score := best[at] + self.unknown) > best[ready]:
                    cost = len(char.encode("utf-8", "surrogatepass")) if self.v.fallback else int(not outside[at])
                    best[ready], pieces[ready], outside[ready] = score, pieces[at] + cost, True

        for end, (length, score) in self.automaton.iter(line):  # by end, longest first
            close(end)
            start, end = end + 1 - length, end + 1
            if (score := best[start] + score) > best[end]:
                best[end], pieces[end], outside[end] = score, pieces[start] + 1, False
        close(len(line))
        return pieces[-1]


_counters: dict[int, UnigramCounter] = {}


def token_counts(docs: DataFrame, vocabulary: UnigramVocabulary, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, keep and n_tokens. The vocabulary is sent to the workers once; its size is that of the tokenizer's file.

    keep: columns of docs, but doc_id and n_tokens, that pass through.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["doc_id", *keep, "n_tokens"]
    rows = docs.select("doc_id", "text", *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)])
    kinds = docs.select(*[F.col(c) for c in keep]).schema if keep else []
    schema = ", ".join(["doc_id long", *[f"`{k.name}` {k.dataType.simpleString()}" for k in kinds], "n_tokens long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sent.value
        counter = _counters.get(id(key)) or _counters.setdefault(id(key), UnigramCounter(key))
        for batch in batches:
            n = np.fromiter((counter.count(t.as_py()) for t in batch.column(1)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(n)], names=names)

    return map_batches(rows, run, schema)
