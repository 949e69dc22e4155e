"""BPE encoding by dynamic programming over prefixes, and decoding.

The encoding of every prefix of a word ends in exactly one token. It is found from left to right: an automaton over the
vocabulary reports which tokens are suffixes of the prefix; of these, one stands behind the last token of the shorter
prefix it leaves in such a way that no merge would have joined the two across their border. Following the stored tokens
back from the end of the word gives its ids, the same that applying all merges in order gives.

Words are what the tokenizer file's normalizer and splitting pattern make of a text; they repeat, so a worker remembers the
ids of a bounded number of blank-separated parts. Nothing is shuffled, and no text depends on another.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Blank-separated parts that a worker remembers, and the longest of them; longer ones are encoded each time.
KNOWN, LONGEST = 250_000, 64
#: Border tests that a worker remembers.
TESTED = 400_000
END = 256  # the symbol of a byte that ends a word is 256 above that of the byte

#: Characters that no composition changes, that every Unicode version treats alike, and whose lower case is one character.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-įı-ňŊ-ž]*")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_names() -> list[str]:
    """The printable character that stands for each byte in vocabularies of bytes."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens as strings of symbols, how each came about, and the automaton that finds them."""

    def __init__(self, model: dict) -> None:
        import ahocorasick

        names = byte_names()
        suffix = model.get("end_of_word_suffix") or ""
        symbol = {c: chr(b) for b, c in enumerate(names)}
        if suffix:
            symbol |= {c + suffix: chr(END + b) for b, c in enumerate(names)}
        ids = model["vocab"]
        self.has_ends = bool(suffix)
        self.form = {ids[name]: s for name, s in symbol.items()}  # id -> symbols
        self.rank = dict.fromkeys(self.form, -1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}  # pair -> rank
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, whole = ids[left], ids[right], ids[left + right]
            if whole in self.rank or a not in self.rank or b not in self.rank:
                raise ValueError(f"merge {rank} makes a token a second time or of tokens not made yet")
            self.form[whole] = self.form[a] + self.form[b]
            self.rank[whole], self.parts[whole], self.merged[a, b] = rank, (a, b), rank
        self.finder = ahocorasick.Automaton()
        made = set()  # tokens that merging their own symbols gives back
        for i, form in self.form.items():
            if i not in self.parts or (made.issuperset(self.parts[i]) and self._apart(*self.parts[i], self.rank[i])):
                made.add(i)
                self.finder.add_word(form, (i, len(form)))
        self.finder.make_automaton()
        self.tested: dict[int, bool] = {}  # last token and next, in one number

    def _apart(self, a: int, b: int, before: int) -> bool:
        """True if no merge of a rank under ``before`` joins ``a`` and ``b``, nor an earlier state of them.

        Merging is run backwards: of the two tokens at the border, the one made last falls apart, and what was at the
        border before must not have had a merge of its own that came first. Of equal merges the left one comes first.
        """
        rank, merged, parts = self.rank, self.merged, self.parts
        while True:
            joined = merged.get((a, b))
            if joined is not None and joined < before:
                return False
            if rank[a] > rank[b]:
                before = rank[a]
                a = parts[a][1]
            elif rank[b] >= 0:
                before = rank[b] + 1
                b = parts[b][0]
            else:
                return True

    def encode(self, word: str) -> bytes:
        """Ids of one word, of which bytes beyond UTF-8 are surrogates; ids are 32-bit numbers in the machine's order throughout."""
        symbols = word if word.isascii() else word.encode("utf-8", "surrogateescape").decode("latin-1")
        if self.has_ends:
            symbols = symbols[:-1] + chr(END + ord(symbols[-1]))
        n = len(symbols)
        last, size = [-1] * n, [0] * n  # the last token of each prefix, and its length
        tested = self.tested
        for at, (token, length) in self.finder.iter(symbols):  # tokens that end at a place, longest first
            if size[at]:
                continue
            if at >= length:
                pair = last[at - length] << 20 | token
                apart = tested.get(pair)
                if apart is None:
                    if len(tested) >= TESTED:
                        tested.clear()
                    apart = tested[pair] = self._apart(last[at - length], token, len(self.merged))
                if not apart:
                    continue
            last[at] = token
            size[at] = length
        out, at = [], n - 1
        while at >= 0:
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return array("i", out).tobytes()


class Codec:
    """Texts to ids and back, as a tokenizer file of byte symbols says."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["model"].get("dropout") or spec["model"].get("ignore_merges"):
            raise ValueError("a tokenizer file with plain BPE merges is needed")
        own = Tokenizer.from_file(path)
        self.normalizer, self.splitter = own.normalizer, own.pre_tokenizer
        self.words = self._pattern(spec)
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens are supported as plain strings of the text only")
        self.added = {t["content"]: t["id"] for t in added}
        self.added_ids = {t: array("i", [i]).tobytes() for t, i in self.added.items()}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.vocabulary = Vocabulary(spec["model"])
        self.names = {i: t for t, i in (spec["model"]["vocab"] | self.added).items()}
        kind = (spec.get("decoder") or {"type": None})["type"]
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"decoder {kind} is not supported")
        self.joined = kind is not None
        self.byte_of = {ord(c): b for b, c in enumerate(byte_names())}
        self.names_of_bytes = byte_names()

    @staticmethod
    def _pattern(spec: dict) -> regex.Pattern | None:
        """The splitting pattern, if plain texts may be lowered and split by it without the library."""
        def steps(part: dict | None, key: str) -> list[dict]:
            return [] if part is None else part.get(key, [part])

        rules = steps(spec.get("normalizer"), "normalizers")
        splits = steps(spec.get("pre_tokenizer"), "pretokenizers")
        known = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
        if rules != known or [s["type"] for s in splits] != ["Split", "ByteLevel"]:
            return None
        split, bytes_ = splits
        if (split["behavior"], split["invert"], bytes_["add_prefix_space"], bytes_["use_regex"]) != ("Removed", True, False, False):
            return None
        return regex.compile(split["pattern"]["Regex"])

    def split(self, text: str) -> list[str]:
        """The parts of a text without added tokens: blank-separated and lowered of plain texts, words of others."""
        if self.words is not None and PLAIN.fullmatch(text):
            return text.lower().split()
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        back = self.byte_of
        return [bytes(back[ord(c)] for c in w).decode("utf-8", "surrogateescape") for w, _ in self.splitter.pre_tokenize_str(text)]

    def learn(self, part: str, known: Words) -> bytes:
        """Ids of a part: those of its words, one after the other."""
        if not part.isalpha() and self.words is not None:  # letters alone are one word
            if part[-1] in ".,!?" and part[:-1].isalpha():
                return known.one(part[:-1]) + known.one(part[-1])
            words = self.words.findall(part) if PLAIN.fullmatch(part) else [part]
            if words != [part]:
                return b"".join(known.all(words))
        return self.vocabulary.encode(part)

    def encode(self, text: str | None, known: Words) -> bytes:
        """Ids of a whole text; null and empty texts have none."""
        if not text:
            return b""
        pieces = self.marks.split(text) if any(map(text.__contains__, self.added)) else [text]
        return b"".join(self.added_ids[p] if p in self.added_ids else b"".join(known.all(self.split(p))) for p in pieces if p)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids. Without a decoder in the file, tokens stand as they are, with a blank between."""
        if not self.joined:
            return " ".join(map(self.names.__getitem__, ids))
        name = "".join(map(self.names.__getitem__, ids))
        return bytes(self.byte_of[ord(c)] for c in name).decode("utf-8", "replace")


class Words:
    """Ids of parts met lately: two generations, of which the older goes when the younger is full."""

    def __init__(self, codec: Codec) -> None:
        self.codec: Codec = codec
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def all(self, parts: list[str]) -> list[bytes]:
        found = [*map(self.young.get, parts)]
        if None in found:
            at = -1
            for _ in range(found.count(None)):
                at = found.index(None, at + 1)
                found[at] = self.one(parts[at])
        return found

    def one(self, part: str) -> bytes:
        ids = self.young.get(part)
        if ids is None:
            ids = self.old.get(part)
            if ids is None:
                ids = self.codec.learn(part, self)
            if len(part) <= LONGEST:
                if len(self.young) >= KNOWN:
                    self.old, self.young = self.young, {}
                self.young[part] = ids
        return ids


_codecs: dict[str, tuple[Codec, Words]] = {}


def codec(path: str) -> tuple[Codec, Words]:
    """A worker's codec of a file, and the words that it remembers from one task to the next."""
    if path not in _codecs:
        _codecs.clear()
        own = Codec(path)
        _codecs[path] = own, Words(own)
    return _codecs[path]


def _mapped(df: DataFrame, source: str, added: dict[str, str], make: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> DataFrame:
    """Add the columns ``added`` (with their types), made of column ``source`` in small batches, whatever else the rows hold."""
    for name in added:
        if name in df.columns:
            raise ValueError(f"the input has a column {name} already")
    fields = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields]
                       + [f"`{name}` {kind}" for name, kind in added.items()])
    place = df.columns.index(source)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([*part.columns, *step(part.column(place))], [*part.schema.names, *added])

    return df.mapInArrow(each, fields)


def _ids(coded: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(c) // 4 for c in coded)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), np.int32)))


def encode_texts(df: DataFrame, text_col: str = "text", ids_col: str = "ids", tokenizer: str | None = None,
                 decoded_col: str | None = None) -> DataFrame:
    """Every row with the ids of its whole text, ``array<int>``; null and empty texts have none, other columns pass through.

    Strings of added tokens in a text are these tokens, as in the library. A text is encoded whole and alone, so repeated
    rows, order and partitions make no difference. An empty table stays empty. With ``decoded_col`` the ids are decoded
    again in the same pass, as ``decode_ids`` does.
    """
    path = tokenizer or default_tokenizer()

    def make():
        own, words = codec(path)

        def step(texts: pa.Array) -> list[pa.Array]:
            coded = [own.encode(t, words) for t in texts.to_pylist()]
            back = [pa.array([own.decode(array("i", c)) for c in coded], pa.string())] if decoded_col else []
            return [_ids(coded), *back]

        return step

    return _mapped(df, text_col, {ids_col: "array<int>", **({decoded_col: "string"} if decoded_col else {})}, make)


def decode_ids(df: DataFrame, ids_col: str = "ids", text_col: str = "decoded", tokenizer: str | None = None) -> DataFrame:
    """Every row with the text of its ids as the tokenizer file's decoder says; no ids give an empty text."""
    path = tokenizer or default_tokenizer()

    def make():
        own, _ = codec(path)
        return lambda ids: [pa.array([own.decode(i or []) for i in ids.to_pylist()], pa.string())]

    return _mapped(df, ids_col, {text_col: "string"}, make)


def coded_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` of each row: its text encoded, and the ids decoded again."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return encode_texts(rows, tokenizer=tokenizer, decoded_col="decoded").drop("text")
