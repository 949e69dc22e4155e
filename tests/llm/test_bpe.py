"""Prefix encoding against the tokenizers library, ids by ids."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from coursemill.llm import bpe

POOLS = ["abcdefghijklmnopqrstuvwxyz", "aaaab ", "éèàüßÉÈ ñÑ'", "ΣσςАБВя你好世界 ", "́̈eEoO가가", "😀👍🏽‍ ",
         "\t\n\r\x0b\x0c\x1c\x85\xa0  　\xad\x00\x7f", "0123456789½²①", "<|startoftext|><|endoftext|>", "'s't're've'm'll'd", "İIıǅŉſK"]


def texts(n=1500, seed=5):
    r = random.Random(seed)
    out = ["", "a", " ", "ab" * 20_000, "<|endoftext|>", "x<|startoftext|>y<|endoftext|"]
    for _ in range(n):
        out.append("".join(r.choice(r.choice(POOLS)) if r.random() < .7 else r.choice(["<|startoftext|>", "<|endoftext|>", " ", "the", "Straße"])
                           for _ in range(r.randint(0, 60))))
        out.append("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(1, 30))) + " " + "".join(r.choice("ab") for _ in range(r.randint(1, 30))))
    return out


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_and_decoded_texts_are_those_of_the_library(name):
    path = public_tokenizers.path(name)
    library, own = Tokenizer.from_file(path), bpe.Codec(path)
    words = bpe.Words(own)
    rows = texts()
    for text, want in zip(rows, library.encode_batch(rows, add_special_tokens=False)):
        ids = np.frombuffer(own.encode(text, words), np.int32).tolist()
        assert ids == want.ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False), text


def test_few_remembered_words_change_nothing(monkeypatch):
    own, _ = bpe.codec(bpe.default_tokenizer())
    rows = texts(200, 9)
    many = [own.encode(t, bpe.Words(own)) for t in rows]
    monkeypatch.setattr(bpe, "KNOWN", 3)
    monkeypatch.setattr(bpe, "TESTED", 2)
    few = bpe.Words(own)
    assert [own.encode(t, few) for t in rows] == many


def test_rows_keep_their_other_columns(spark, hard):
    out = bpe.decode_ids(bpe.encode_texts(hard))
    both = bpe.encode_texts(hard, decoded_col="decoded")
    assert sorted(map(str, out.collect())) == sorted(map(str, both.collect()))
    assert out.columns == [*hard.columns, "ids", "decoded"]
    library = Tokenizer.from_file(bpe.default_tokenizer())
    rows = out.collect()
    assert len(rows) == hard.count() and {r["_note"] for r in rows} == {"z"}
    for r in rows:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.decode_ids(bpe.encode_texts(hard.limit(0))).collect() == []
    with pytest.raises(ValueError, match="column size"):
        bpe.encode_texts(hard, ids_col="size")


def test_large_ids_beside_null_stay(spark):
    big = 9007199254740993
    got = bpe.coded_documents(spark.createDataFrame([(big, "a"), (None, "b"), (big + 2, None)], "doc_id bigint, text string").coalesce(1)).collect()
    assert [r["doc_id"] for r in got] == [big, None, big + 2] and got[2]["ids"] == [] and got[2]["decoded"] == ""
