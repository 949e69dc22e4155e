"""Language identification with hyperdimensional profiles.

A letter is a random vector of +1 and -1, drawn from its code point. A trigram binds its letters, each rotated by its
place, by multiplication; a text and a language bundle their trigrams by addition; a text belongs to the language with
the largest cosine. Prototypes are sums over all training documents, added up per task and then by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import shield
DIMENSIONS, SEED = 1024, 20
#: Texts whose trigrams are counted together, and trigrams whose vectors are held at once.
GROUP, VECTORS = 128, 512

_letters: dict[int, np.ndarray] = {}
_alpha: list[np.ndarray] = []


def _letter(code: int) -> np.ndarray:
    if code not in _letters:
        if len(_letters) > 4096:  # vectors are drawn again when needed; this only bounds memory
            _letters.clear()
        _letters[code] = (np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1).astype(np.int8)
    return _letters[code]


def trigrams(text: str) -> np.ndarray:
    """One number per trigram of lower-case letters; a run of other characters, or an end, is one gap. No letters: none."""
    if not _alpha:
        _alpha.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.where(_alpha[0][codes], codes, 32)
    codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]
    return codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:] if len(codes) > 2 else np.empty(0, np.int64)


def trigram_vectors(grams: np.ndarray) -> np.ndarray:
    places = [grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF]
    codes, index = np.unique(np.concatenate(places), return_inverse=True)
    letters = np.stack([_letter(int(c)) for c in codes])
    a, b, c = index.reshape(3, -1)
    return np.roll(letters, 2, axis=1)[a] * np.roll(letters, 1, axis=1)[b] * letters[c]


def _bundles(texts: list[str | None], owner: np.ndarray | None = None, owners: int = 0) -> np.ndarray:
    """The bundled vector of each text, or of each owner of texts."""
    grams = [trigrams(t) if isinstance(t, str) else np.empty(0, np.int64) for t in texts]
    own = np.arange(len(texts)) if owner is None else owner
    owners = owners or len(texts)
    keys, index = np.unique(np.concatenate(grams), return_inverse=True)
    if not len(keys):
        return np.zeros((owners, DIMENSIONS), np.float32)
    cells = np.repeat(own, [len(g) for g in grams]) * len(keys) + index
    counts = np.bincount(cells, minlength=owners * len(keys)).reshape(owners, -1)
    kind = np.float32 if owner is None else np.float64  # sums of languages stay exact
    bundles = np.zeros((owners, DIMENSIONS), kind)
    for at in range(0, len(keys), VECTORS):  # sums of whole numbers: exact in any order
        bundles += counts[:, at:at + VECTORS].astype(kind) @ trigram_vectors(keys[at:at + VECTORS]).astype(kind)
    return bundles


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, np.ndarray]:
    """A prototype per language from all rows with text and language; only sums, of the size of the languages, come back."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, len(batch), GROUP):
                part = batch.iloc[at:at + GROUP]
                names, owner = np.unique(part["lang"].to_numpy(str), return_inverse=True)
                for name, v in zip(names.tolist(), _bundles(part["text"].tolist(), owner, len(names)), strict=True):
                    total[name] = total.get(name, 0) + v.astype(np.int64)
        if total:
            yield pd.DataFrame({"lang": list(total), "sums": [v.tolist() for v in total.values()]})

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    parts = rows.mapInPandas(sums, "lang string, sums array<bigint>").select("lang", F.posexplode("sums").alias("at", "x"))
    cells = parts.groupBy("lang", "at").agg(F.sum("x").alias("x"))
    found = cells.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("cells")).collect()
    return {r["lang"]: np.array([c["x"] for c in r["cells"]], np.float64) for r in sorted(found, key=lambda r: r["lang"])
            if any(c["x"] for c in r["cells"])}


def predict(text: Column, prototypes: dict[str, np.ndarray]) -> Column:
    """``struct(lang_pred, score)``: the nearest language and its cosine, 0 at least. ``und`` and 0 for null and empty
    texts, texts without letters, and if nothing was learned. Ties go to the smaller name."""
    names = sorted(prototypes)
    unit = np.stack([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names]).astype(np.float32) if names else None

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        out = []
        for at in range(0, len(texts), GROUP):
            v = _bundles(texts.iloc[at:at + GROUP].tolist())
            size = np.linalg.norm(v, axis=1)
            if unit is None:
                out += [("und", 0.0)] * len(v)
                continue
            cosine = (v @ unit.T) / np.maximum(size, 1e-9)[:, None]
            best = cosine.argmax(axis=1)
            out += [(names[b], min(1.0, max(0.0, float(c[b])))) if s > 0 else ("und", 0.0)
                    for b, c, s in zip(best.tolist(), cosine, size.tolist(), strict=True)]
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return nearest(text)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Rows never learned from: CRC-32 of the id as text divides by ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0


#: A text's cosine with its own language grows with its length. On held-out texts cut to 10 to 800 characters, 99 of 100 lie
#: above MOST * n / (n + HALF) at every length n; texts in other languages fall below it from about a hundred characters on.
MOST, HALF = 0.27, 150


def unlike_any(text: Column, score: Column) -> Column:
    """Whether a text resembles its nearest language less than nearly all texts of its length do."""
    n = F.length(text)
    return score < F.lit(MOST) * n / (n + HALF)


def identify(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Input rows with ``held_out``, ``lang_pred`` and ``score``; columns of these names are replaced.

    Learned from rows that are not held out and have text and language. Only the text decides a prediction, so repeated
    texts agree. An empty table stays empty.
    """
    prototypes = learn(docs.where(~held_out(id_col)), lang_col, text_col)
    docs, back = shield(docs, [id_col, lang_col, text_col], ("held_out", "lang_pred", "score"))
    rows = docs.withColumn("held_out", held_out(id_col)).withColumn("_p", predict(F.col(text_col), prototypes))
    return back(rows.select("*", "_p.lang_pred", "_p.score").drop("_p"))
