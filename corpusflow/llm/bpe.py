"""BPE encoding and decoding of whole texts.

Each word is a doubly linked list of symbols; the ranks of adjacent pairs sit
in a priority queue, and an entry whose symbols have changed since it was
queued is skipped as stale. Decoding concatenates vocabulary strings.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import text_blocks

#: A tokenizer file above this size is not shipped to the executors.
MAX_MODEL_BYTES = 64_000_000
#: Words that one Python worker remembers; the table is emptied when full, so
#: its memory is bounded and results do not depend on it.
MAX_CACHED_WORDS = 150_000
MAX_CACHED_CHARS = 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself where it is printable Latin-1, else the next free
    character from U+0100."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class WordBPE:
    """Tokenizer read from the text of a ``tokenizers`` JSON file with a
    word-end BPE model: NFC, white space runs, lower case; words by the file's
    pattern; byte-level symbols, the last one of a word carrying the suffix."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("a BPE model without byte fallback or subword prefix is needed")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in chain(self.vocab.items(), self.added.items())}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.symbols = byte_symbols()
        self.cache: dict[str, tuple[int, str, str]] = {}

    def merge(self, word: str) -> list[str]:
        """Symbols of one word after all merges, lowest rank first, leftmost
        first among equals."""
        sym = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        sym[-1] += self.suffix
        n = len(sym)
        ranks = self.ranks
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            r = ranks.get((sym[i], sym[i + 1]))
            if r is not None:
                queue.append((r, i, sym[i], sym[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = nxt[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue  # stale: one of the two has been merged meanwhile
            sym[i], sym[j] = a + b, ""
            k = nxt[i] = nxt[j]
            if k < n:
                prev[k] = i
                r = ranks.get((sym[i], sym[k]))
                if r is not None:
                    heapq.heappush(queue, (r, i, sym[i], sym[k]))
            h = prev[i]
            if h >= 0:
                r = ranks.get((sym[h], sym[i]))
                if r is not None:
                    heapq.heappush(queue, (r, h, sym[h], sym[i]))
        return [s for s in sym if s]

    def word_ids(self, word: str) -> list[int]:
        return [self.vocab[s] for s in self.merge(word) if s in self.vocab]

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """(words' text or added token, is it an added token)."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield text[at : m.start()], False
            yield m.group(), True
            at = m.end()
        yield text[at:], False

    def split(self, text: str) -> list[str]:
        # Lower-casing goes character by character: a word-final capital sigma
        # is not special.
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part, special in self.pieces(text):
            if special:
                out.append(self.added[part])
            else:
                for w in self.split(part):
                    out += self.word_ids(w)
        return out

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings of the ids, one space between them (the file
        names no decoder)."""
        return " ".join(self.strings[i] for i in ids if i in self.strings)

    def _lookup(self, word: str) -> tuple[int, str, str]:
        ids = self.word_ids(word)
        found = (len(ids), " ".join(map(str, ids)), " ".join(self.strings[i] for i in ids))
        if len(word) <= MAX_CACHED_CHARS:
            if len(self.cache) >= MAX_CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = found
        return found

    def digest(self, text: str) -> tuple[int, str, str]:
        """(tokens, sha256 of the ids joined by spaces, sha256 of the decoded
        text), fed in runs so that no whole token list is held."""
        n, ids, dec = 0, hashlib.sha256(), hashlib.sha256()
        get, first = self.cache.get, True
        for part, special in self.pieces(text):
            if special:
                found = [(1, str(self.added[part]), part)]
            else:
                found = [get(w) or self._lookup(w) for w in self.split(part)]
            for i in range(0, len(found), 1 << 16):
                run = [f for f in found[i : i + (1 << 16)] if f[0]]
                if run:
                    counts, left, right = zip(*run)
                    n += sum(counts)
                    lead = "" if first else " "
                    ids.update((lead + " ".join(left)).encode())
                    dec.update((lead + " ".join(right)).encode())
                    first = False
        return n, ids.hexdigest(), dec.hexdigest()


_LOADED: dict[int, WordBPE] = {}


def _tokenizer(model) -> WordBPE:
    """The tokenizer of a broadcast file, built once per Python worker."""
    key = hash(model.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBPE(model.value)
    return _LOADED[key]


def load_model(spark: SparkSession, path: str):
    """Read the tokenizer file at ``path`` on the driver and ship its text; a
    file above ``MAX_MODEL_BYTES`` is refused."""
    with open(path, encoding="utf-8") as f:
        text = f.read(MAX_MODEL_BYTES + 1)
    if len(text) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return spark.sparkContext.broadcast(text)


def encode_column(text: Column, model) -> Column:
    """Token ids (array of int) of each text; null text is empty."""

    @F.pandas_udf("array<int>")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = _tokenizer(model)
        for texts in it:
            yield pd.Series([t.encode(x) for block in text_blocks(texts) for x in block], dtype=object)

    return run(text)


def decode_column(ids: Column, model) -> Column:
    """Text of each id array; null ids are empty, unknown ids are skipped."""

    @F.pandas_udf("string")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = _tokenizer(model)
        for rows in it:
            yield pd.Series([t.decode(list(x)) if x is not None else "" for x in rows], dtype=object)

    return run(ids)


def digest_column(text: Column, model) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256) of each text."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        t = _tokenizer(model)
        for texts in it:
            rows = [t.digest(x) for block in text_blocks(texts) for x in block]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run(text)


def bpe_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256``.

    Defined cases: a null text is empty; an empty text has no tokens and the
    digests of empty strings; repeated rows and null ids are kept; an empty
    table gives no rows; other columns are ignored. Row-local, no shuffle.
    """
    model = load_model(docs.sparkSession, path)
    d = docs.select(F.col(id_col).alias("doc_id"), digest_column(F.col(text_col), model).alias("_d"))
    return d.select("doc_id", "_d.n_tokens", "_d.ids_sha256", "_d.decoded_sha256")


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``, the token ids of the whole text."""
    model = load_model(docs.sparkSession, path)
    return docs.select(F.col(id_col).alias("doc_id"), encode_column(F.col(text_col), model).alias("ids"))
