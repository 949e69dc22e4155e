"""Token ids of whole texts, from a tokenizer file, as little-endian unsigned 32-bit bytes.

Where a file is plain byte-level BPE with ids in the order of their merges, its vocabulary is handed to ``tiktoken``, which
merges the same pairs in the same order and is several times faster. Texts with characters that the two libraries could
class differently, or with the string of an added token, go to the tokenizers library itself. Nothing is remembered from
one text to the next.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from functools import cached_property

import numpy as np

from coursemill.llm.bpe import byte_names

#: Characters that every Unicode version classes alike: Latin, Greek, Cyrillic, general and CJK marks, kana, Han, Hangul.
KNOWN = re.compile("[\t\n\r\x20-\x7e¡-ɏΑ-ΡΣ-ώЀ-ӿ‐-‧‰-⁞₠-₿、-〗ぁ-ゖァ-ヺ一-龥가-힣！-～]*")
STOPS = (".", "!", "?", "\n", "。", "！", "？", "．", "｡")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = byte_names()
        self.quick = self._quick(spec, names)
        added = spec.get("added_tokens") or []
        vocabulary = self.tokenizer.get_vocab() if self.quick is None else spec["model"]["vocab"] | {t["content"]: t["id"] for t in added}
        stops = tuple("".join(names[b] for b in s.encode()) for s in STOPS)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that may end a sentence
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith(stops)
        self.added = [t["content"] for t in added]

    @cached_property
    def tokenizer(self):
        """The tokenizers library itself: 30 MB that most workers never need."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @staticmethod
    def _quick(spec: dict, names: list[str]):
        """The same vocabulary for the quicker library, or None if the file asks for more than it can."""
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        back = {c: b for b, c in enumerate(names)}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if model["type"] != "BPE" or spec.get("normalizer") or any(split.get(k) != v for k, v in plain.items()):
            return None
        if model.get("dropout") or model.get("ignore_merges") or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix"):
            return None
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in pairs]
        if made != sorted(made) or len(model["vocab"]) - len(made) - len(names) > len(spec.get("added_tokens") or []):
            return None
        import public_tokenizers
        import tiktoken

        added = {t["content"] for t in spec.get("added_tokens") or []}
        ranks = {bytes(back[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> bytes:
        # The fast form gives the same ids without their places in the text.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def one(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.quick is None or any(map(text.__contains__, self.added)) or not KNOWN.fullmatch(text):
            return self.whole(text)
        ids = array("I", self.quick.encode_ordinary(text))
        if sys.byteorder != "little":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null and empty texts have none."""
        return [*map(self.one, texts)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]
