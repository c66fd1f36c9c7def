"""BPE encoding and decoding over a trie of distinct words.

The words that a batch brings are inserted into a trie by their symbols. A depth-first walk carries, for every depth of
the path, the last token of that prefix's encoding; the encoding of a prefix is that of a shorter prefix plus one
token, so words share the work for what they share, and a word's tokens are read back from its path. A token may follow
another exactly if merging their joined symbols would leave the two, which `follows` decides by undoing merges.

Splitting into words is the tokenizer's: marked special tokens first, then composition, lower case and its pattern.
Texts of Latin letters use an equal pattern here; others go through the library's own normaliser and splitter.

Defined results. Null and empty text: no tokens, and the hash of nothing. Repeated rows: equal results. Very long texts:
one list of words at a time. Empty table: empty result. Extra columns are dropped.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridloom.llm.common import map_batches

#: Words that a worker remembers; beyond it the memory starts anew, which changes no result.
REMEMBER = 400_000
#: Characters of text whose words are looked up together.
TOGETHER = 1 << 20
LATIN = 0x250


def _byte_characters() -> dict[int, str]:
    """A printable character for every byte: itself where it is printable Latin-1, else the next from 256 on."""
    shown = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(rest)) for b in range(256)}


BYTE_OF = {c: b for b, c in _byte_characters().items()}


def _ranges(test) -> str:
    """A class body of the Latin characters that pass."""
    return "".join(re.escape(chr(i)) for i in range(LATIN) if test(chr(i)))


_LETTER = _ranges(lambda c: unicodedata.category(c)[0] == "L")
_NUMBER = _ranges(lambda c: unicodedata.category(c)[0] == "N")
_BLANK = "\t\n\x0b\x0c\r \x85\xa0"
LATIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+")
BEYOND = re.compile(f"[^\\x00-\\u{LATIN - 1:04x}]")


class WordBpe:
    """A tokenizer file of words with an end mark."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        spec = json.loads(source)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("decoder") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("a BPE tokenizer without decoder, dropout and ignore_merges is expected")
        library = Tokenizer.from_str(source)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.text = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        self.text |= {i: t for t, i in self.special.items()}
        self.marked = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.order: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for n, (a, b) in enumerate(pairs):
            left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
            self.order[left, right] = n
            if whole not in self.rank:
                self.halves[whole], self.rank[whole] = (left, right), n
        # Lengths over 2 of the tokens with given last three symbols, longest first; for a word's end and elsewhere.
        self.lengths: dict[str, list[int]] = {}
        self.end_lengths: dict[str, list[int]] = {}
        for token in self.ids:
            ends = bool(self.end) and token.endswith(self.end)
            symbols = token.removesuffix(self.end) if ends else token
            if len(symbols) > 2:
                (self.end_lengths if ends else self.lengths).setdefault(symbols[-3:], []).append(len(symbols))
        for table in (self.lengths, self.end_lengths):
            table |= {k: sorted(set(v), reverse=True) for k, v in table.items()}
        self.symbols = {b: c for b, c in _byte_characters().items()}
        self.allowed: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.memory: dict[str, tuple[str, str]] = {}

    def follows(self, a: int, b: int) -> bool:
        """Whether the joined symbols of a and b are encoded as a, b."""
        if (known := self.allowed.get((a, b))) is not None:
            return known
        x, y, before = a, b, len(self.order) + 1
        ok = True
        while True:
            if (n := self.order.get((x, y))) is not None and n < before:
                ok = False  # this merge across the border would have come first
                break
            m, n = self.rank.get(x, -1), self.rank.get(y, -1)
            if m < 0 and n < 0:
                break
            if m > n:  # the later merge is undone first; of one rank the left is made first
                before, x = m, self.halves[x][1]
            else:
                before, y = n + 1, self.halves[y][0]
        self.allowed[a, b] = ok
        return ok

    def stands(self, token: int) -> bool:
        """Whether the token's own symbols are encoded as the token."""
        if (known := self.whole.get(token)) is None:
            known = True
            if token in self.halves:
                a, b = self.halves[token]
                n = self.rank[token]
                known = self.stands(a) and self.stands(b) and self._joins(a, b, n)
            self.whole[token] = known
        return known

    def _joins(self, a: int, b: int, n: int) -> bool:
        """Whether nothing merges across the border of a and b before rank n does."""
        x, y, before = a, b, n
        while True:
            m, k = self.rank.get(x, -1), self.rank.get(y, -1)
            if m < 0 and k < 0:
                return True
            if m > k:
                before, x = m, self.halves[x][1]
            else:
                before, y = k + 1, self.halves[y][0]
            if (r := self.order.get((x, y))) is not None and r < before:
                return False

    def learn(self, words: Iterable[str]) -> None:
        """Put the ids and tokens of distinct words into memory, by one walk over their trie."""
        root: dict = {}
        symbols, leaves = self.symbols, ""
        for word in words:
            node = root
            line = word.encode().decode("latin-1").translate(symbols)
            for symbol in line[:-1]:
                node = node.get(symbol) or node.setdefault(symbol, {})
            if leaves in node:
                node[leaves].append((line, word))
            else:
                node[leaves] = [(line, word)]
        text_of, memory, last_token, end = self.text, self.memory, self.last_token, self.end
        last: list[tuple[int, int]] = [(-1, 0)]  # by depth: last token and its symbols
        stack: list[tuple[str, dict]] = [("", root)]
        while stack:
            prefix, node = stack.pop()
            if depth := len(prefix):
                del last[depth:]
                last.append(last_token(prefix, last, "", self.lengths))
            for symbol, child in node.items():
                if symbol:
                    stack.append((prefix + symbol, child))
                    continue
                for line, word in child:
                    token, size = last_token(line, last, end, self.end_lengths)
                    found, at = [token], depth + 1 - size
                    while at:
                        token, size = last[at]
                        found.append(token)
                        at -= size
                    found.reverse()
                    memory[word] = " ".join(map(str, found)), " ".join([text_of[i] for i in found])

    def last_token(self, prefix: str, last: list[tuple[int, int]], end: str, lengths: dict[str, list[int]]) -> tuple[int, int]:
        """The last token of the encoding of prefix, and how many symbols it has; last holds the shorter prefixes."""
        depth, ids, whole, allowed = len(prefix), self.ids, self.whole, self.allowed
        for size in lengths.get(prefix[-3:], ()) if depth > 2 else ():
            if size > depth:
                continue
            token = ids.get(prefix[depth - size :] + end)
            if token is None or not (whole[token] if token in whole else self.stands(token)):
                continue
            if size == depth:
                return token, size
            pair = last[depth - size][0], token
            if allowed[pair] if pair in allowed else self.follows(*pair):
                return token, size
        for size in (2, 1):
            if size <= depth and (token := ids.get(prefix[depth - size :] + end)) is not None and self.stands(token) and (size == depth or self.follows(last[depth - size][0], token)):
                return token, size
        raise ValueError(f"no token ends {prefix!r}")

    def words(self, text: str) -> list[str]:
        if not BEYOND.search(text):
            return LATIN_WORDS.findall(text.lower())
        shown = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [bytes(BYTE_OF[c] for c in w).decode() for w, _ in shown]

    def segments(self, text: str) -> list[list[str] | str]:
        """Words of each stretch, and special tokens between them as strings."""
        if not self.marked or not self.marked.search(text):
            return [self.words(text)]
        out, at = [], 0
        for m in self.marked.finditer(text):
            out += [self.words(text[at : m.start()]), m[0]]
            at = m.end()
        return [*out, self.words(text[at:])]

    def encode_all(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """The ids and the decoded text of each text, both as one string."""
        at = 0
        while at < len(texts):
            size, to = 0, at
            while to < len(texts) and (to == at or size + len(texts[to]) <= TOGETHER):
                size += len(texts[to])
                to += 1
            parts = [self.segments(t) for t in texts[at:to]]
            seen = {w for p in parts for s in p if not isinstance(s, str) for w in s}
            if len(self.memory) > REMEMBER:
                self.memory.clear()
            new = [w for w in seen if w not in self.memory]
            if new:
                gc.disable()  # a trie has no cycles, and its many small objects would set off collections
                self.learn(new)
                gc.enable()
            memory = self.memory
            for p in parts:
                found = []
                for s in p:
                    found += [(str(self.special[s]), s)] if isinstance(s, str) else [memory[w] for w in s]
                yield " ".join([a for a, _ in found]), " ".join([b for _, b in found])
            at = to


_loaded: dict[str, WordBpe] = {}


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids joined by spaces and of the decoded text, for every whole text.

    The tokenizer's file is read on the driver and sent to the workers; its size is fixed.
    """
    with open(path, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    name = path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _loaded:
            _loaded[name] = WordBpe(sent.value)
        bpe = _loaded[name]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                n, a, b = [], [], []
                for ids, text in bpe.encode_all([t.as_py() or "" for t in part.column(1)]):
                    n.append(ids.count(" ") + 1 if ids else 0)
                    a.append(hashlib.sha256(ids.encode()).hexdigest())
                    b.append(hashlib.sha256(text.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(n, np.int64)), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
