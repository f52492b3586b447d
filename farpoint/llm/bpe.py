"""BPE encoding and decoding with forced-boundary splitting.

A merge can only join two neighbouring symbols that stand next to each other
inside some vocabulary token. So wherever a word holds a pair of neighbouring
byte symbols that occurs inside no token, every encoding has a cut there. Words
are split at these certain cuts, the fragments are encoded independently, and
their ids are concatenated. Normalising, and the merges of one fragment, are
the public library's own; words seen before come from a bounded cache.

The result equals the library's on the whole text: special-token strings are
cut out first, as the library does, and the text between them is normalised,
split into words and encoded. Null texts are empty: no ids, empty decoding.
Texts of any length are read whole. Documents are encoded one by one, so
repeated rows give repeated results and empty tables none.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import kept_in_worker, per_batch, texts_of

END = "</w>"
# One worker for each core holds these tables at once, and keeps them for later tasks.
CACHE_WORDS, CACHE_IDS = 100_000, 1_200_000
PIECE_CHARS = 1 << 17
SLICE_ROWS = 1000
# Latin text below U+0180 is normalised and split by Python alone: there the normal form
# is the text itself, lower-casing maps single characters, and these are the classes of
# the file's pattern. Any other text takes the library's own normaliser and splitter.
NOT_LATIN = re.compile("[^\x00-\u012f\u0131-\u017f]")
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_BLANK = "\t\n\x0b\x0c\r \x85\xa0"
LATIN_WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+")


def byte_symbols() -> dict[int, str]:
    """Byte-level BPE's printable character for every byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


def forced_pairs(vocab: dict[str, int]) -> tuple[set[str], set[str]]:
    """Neighbouring symbols found inside tokens: before the word's end, and at it."""
    inner, last = set(), set()
    for token in vocab:
        ends = token.endswith(END) and len(token) > len(END)
        symbols = token[:-len(END)] if ends else token
        pairs = list(map("".join, zip(symbols, symbols[1:], strict=False)))
        if ends and pairs:
            last.add(pairs.pop())
        inner.update(pairs)
    return inner, last


def split_forced(word: str, inner: set[str], last: set[str]) -> list[str]:
    """``word`` cut at every pair that no token holds."""
    pairs = list(map(add, word, word[1:]))
    if not pairs or pairs[-1] in last and inner.issuperset(pairs[:-1]):
        return [word]
    cuts = [i for i, pair in enumerate(pairs[:-1], 1) if pair not in inner]
    if pairs[-1] not in last:
        cuts.append(len(pairs))
    return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]


class WordBpe:
    """Encoder for a word-level BPE file with an end-of-word suffix and no decoder."""

    def __init__(self, spec: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        parsed = json.loads(spec)
        vocab, merges = parsed["model"]["vocab"], parsed["model"]["merges"]
        merges = [tuple(m) for m in merges]
        bare = {**parsed, "model": {**parsed["model"], "vocab": {}, "merges": []},
                "added_tokens": [], "post_processor": None}
        self.normalizer = Tokenizer.from_str(json.dumps(bare)).normalizer
        split = parsed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.splitter = pre_tokenizers.Split(Regex(split), "removed", invert=True)
        self.final = Tokenizer(models.BPE(vocab, merges, end_of_word_suffix=END))
        # a fragment before the word's end never makes a token that closes a word
        self.inside = Tokenizer(models.BPE(
            {t: i for t, i in vocab.items() if not t.endswith(END)},
            [m for m in merges if not m[1].endswith(END)]))
        for part in (self.final, self.inside):
            part.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.inner, self.last = forced_pairs(vocab)
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.names = {str(i): t for t, i in [*vocab.items(), *self.special.items()]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.symbols = byte_symbols()
        self.cache, self.cache_words = {}, cache_words

    def fragments(self, words: list[str]) -> list[list[str]]:
        """Every word's byte symbols, cut at the forced boundaries."""
        return [split_forced(w.encode().decode("latin-1").translate(self.symbols),
                             self.inner, self.last) for w in words]

    @staticmethod
    def encoded(model, parts: list[str]) -> list[list[int]]:
        """Ids of each fragment on its own."""
        ids = [[] for _ in parts]
        if parts:
            found = model.encode(" ".join(parts), add_special_tokens=False)
            for place, token in zip(found.word_ids, found.ids, strict=True):
                ids[place].append(token)
        return ids

    def ids_of_words(self, words: list[str]) -> Iterator[list[int]]:
        """Ids of every word, fragment by fragment."""
        cut = self.fragments(words)
        body = iter(self.encoded(self.inside, [p for parts in cut for p in parts[:-1]]))
        for parts, end in zip(cut, self.encoded(self.final, [parts[-1] for parts in cut]),
                              strict=True):
            yield [i for _ in parts[1:] for i in next(body)] + end

    def learn(self, words: list[str]) -> None:
        """Encode words not seen before and remember their ids, joined by spaces."""
        for word, ids in zip(words, self.ids_of_words(words), strict=True):
            self.cache[word] = " ".join(map(str, ids))

    def words(self, text: str) -> list[str]:
        """The words of a text in order; special tokens stand as themselves."""
        if "<|" not in text:
            return self.plain_words(text)
        out = []
        for place, piece in enumerate(self.cut.split(text)):
            out += [piece] if place % 2 else self.plain_words(piece)
        return out

    def plain_words(self, text: str) -> list[str]:
        if not NOT_LATIN.search(text):
            return LATIN_WORD.findall(text.lower())
        norm = self.normalizer.normalize_str(text)
        return [word for word, _ in self.splitter.pre_tokenize_str(norm)]

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """For each text (number of ids, ids joined by spaces, decoded text)."""
        for piece in pieces(texts):
            found = [self.words(t) for t in piece]
            wanted = set().union(*found).difference(self.special)
            new = wanted.difference(self.cache)
            if len(self.cache) + len(new) > self.cache_words:
                self.cache = {w: self.cache[w] for w in wanted.difference(new)}
            self.learn(sorted(new))
            special = {w: str(i) for w, i in self.special.items()} \
                if any("<|" in t for t in piece) else {}
            for words in found:
                if special and not special.keys().isdisjoint(words):
                    ids = " ".join([special.get(w) or self.cache[w] for w in words])
                else:
                    ids = " ".join(map(self.cache.__getitem__, words))
                yield ids.count(" ") + 1 if ids else 0, ids, self.decode(ids)

    def ids(self, text: str) -> list[int]:
        joined = next(self.encode_texts([text]))[1]
        return list(map(int, joined.split(" "))) if joined else []

    def decode(self, ids: str) -> str:
        """The vocabulary strings of ids, all joined by one space, special tokens included."""
        return " ".join(map(self.names.__getitem__, ids.split(" "))) if ids else ""


class WordIds:
    """Id arrays of texts, gathered from flat arrays of the ids of words seen before."""

    def __init__(self, bpe: WordBpe, cache_words: int = CACHE_IDS):
        self.bpe, self.cache_words = bpe, cache_words
        self.forget()

    def forget(self) -> None:
        special = self.bpe.special
        self.code = {word: i for i, word in enumerate(special)}
        self.flat = np.array(list(special.values()), dtype=np.int32)
        self.count = np.ones(len(special), dtype=np.int64)
        self.first = np.arange(len(special))

    def learn(self, words: list[str]) -> None:
        found = list(self.bpe.ids_of_words(words))
        count = np.array([len(f) for f in found], dtype=np.int64)
        self.code.update(zip(words, range(len(self.code), len(self.code) + len(words)),
                             strict=True))
        self.first = np.r_[self.first, len(self.flat) + np.cumsum(count) - count]
        self.count = np.r_[self.count, count]
        self.flat = np.r_[self.flat, np.array([i for f in found for i in f], dtype=np.int32)]

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        for piece in pieces(texts, 8 * PIECE_CHARS):
            found = [self.bpe.words(t) for t in piece]
            new = set().union(*found).difference(self.code)
            if len(self.code) + len(new) > self.cache_words:
                self.forget()
                new = set().union(*found).difference(self.code)
            if new:
                self.learn(sorted(new))
            for words in found:
                code = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
                count = self.count[code]
                upto = np.cumsum(count)
                total = int(upto[-1]) if len(upto) else 0
                yield self.flat[np.repeat(self.first[code] - upto + count, count)
                                + np.arange(total)]


def pieces(texts: list[str], chars: int = PIECE_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``chars`` characters together."""
    piece, size = [], 0
    for text in texts:
        piece.append(text)
        size += len(text)
        if size >= chars:
            yield piece
            piece, size = [], 0
    if piece:
        yield piece


def vocabulary_text(path: str | None = None) -> str:
    """The tokenizer file's text; by default the public word-level vocabulary."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per document: number of ids and digests of its ids and of its decoded text."""
    text = vocabulary_text(vocabulary)
    shared, name = docs.sparkSession.sparkContext.broadcast(text), sha256(text)

    def make():
        bpe = kept_in_worker(("word-bpe", name), lambda: WordBpe(shared.value))

        def work(batch):
            for start in range(0, batch.num_rows, SLICE_ROWS):
                some = batch.slice(start, SLICE_ROWS)
                found = [(n, sha256(ids), sha256(tokens)) for n, ids, tokens in
                         bpe.encode_texts(texts_of(some))]
                yield pa.RecordBatch.from_arrays(
                    [pc.cast(some.column("doc_id"), pa.int64()),
                     *map(pa.array, zip(*found, strict=True))],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return work
    return per_batch(docs.select("doc_id", "text"), DIGEST, make)
