"""An interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by workers.

Texts are counted block by block; a block sends each different word and each different bigram
once, with its count, packed by hash range. Bigrams are dealt by their first word, so a range knows
all continuations of a word; the few words that begin more than a given share of all bigrams are
dealt by both words. Each range writes its counts as sorted hash arrays to the shared folder,
by renaming a finished file, so a task that runs twice does no harm. Workers map the files, look a
block's different words and bigrams up in ascending order, and sum the logarithms per text.

Counts grow with the corpus and so do the files; nothing of that size is sent to the driver or
broadcast. The driver gets the counts of counts, and of words that begin many bigrams, of which there
are fewer than ``1 / HOT_SHARE``. The shared folder must be mounted at the same path on all nodes.

The model: p(w | h) = max(c(h w) - D(c(h w)), 0) / c(h) + b(h) p(w), where D has the three discounts of the
modified method, b(h) is what they free, and p(w) is made likewise from the number of different
words before w, with a uniform share for unseen words. Words are 64-bit hashes, second words 32-bit ones.

Nulls and edge cases: a null or empty text is the end token alone. Repeated rows count each. A null
``doc_id`` is scored. Without training texts every word has the uniform share. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import texts
from corvane.llm.exchange import ranges_for, written
from corvane.llm.window_dedup import _part_of
from corvane.session import scratch_path

# Fixed hashes of the tokens that are no words: the place before a text, and its end.
START, END = np.uint64(1), np.uint64(2)
HOT_SHARE = 1e-3
COUNT_BLOCK = 8 << 20


def tokens(block: texts.Block) -> tuple[np.ndarray, np.ndarray]:
    """All texts' word hashes, each text closed by ``END``, and where each text begins."""
    words = texts.find_words(block)
    hashes = texts.word_hashes(block, words, lower=True)
    first = words.first + np.arange(len(words.first))
    out = np.full(len(hashes) + len(block), END, np.uint64)
    places = np.arange(len(hashes)) + words.owners()
    out[places] = hashes
    return out, first


def _before(tokens_: np.ndarray, first: np.ndarray) -> np.ndarray:
    previous = np.empty_like(tokens_)
    previous[1:] = tokens_[:-1]
    previous[first[:-1]] = START
    return previous


def _short(hashes: np.ndarray) -> np.ndarray:
    return texts.mix(hashes) >> np.uint64(32)


def _keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The bigrams' hashes; ``word`` is short."""
    return texts.mix(before ^ texts.mix(word + np.uint64(0x632BE59BD9B4E019)))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def local_path(uri: str) -> str:
    parsed = urlparse(uri)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"the model's folder must be a mounted path, not {uri}")
    return parsed.path


def _save(folder: str, name: str, part: int, array: np.ndarray) -> None:
    path = f"{folder}/{name}-{part}.npy"
    draft = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
    os.makedirs(folder, exist_ok=True)
    with open(draft, "wb") as file:
        np.save(file, array)
    os.replace(draft, path)


@dataclass
class Model:
    """Where the arrays are and the few numbers that all share."""

    folder: str
    parts: int
    train_tokens: int
    types: int
    discounts: list[float]  # of bigrams counted 1, 2, 3 or more times
    low_discounts: list[float]  # of words with 1, 2, 3 or more different words before them
    bigram_types: int
    low_free: float  # what the low discounts free
    hot: np.ndarray  # words that begin very many bigrams, ascending
    hot_free: np.ndarray
    starts: int
    written: dict[str, frozenset]  # by array the ranges that have one
    mapped: dict = field(default_factory=dict)

    def array(self, name: str, part: int) -> np.ndarray:
        """A range's array; one that was written and is not to be seen here is an error, not an empty one."""
        key = (name, part)
        if key not in self.mapped:
            path = f"{self.folder}/{name}-{part}.npy"
            if part not in self.written[name]:
                self.mapped[key] = np.zeros(0, np.uint64)
            elif os.path.getsize(path) > 128:
                self.mapped[key] = np.load(path, mmap_mode="r")
            else:
                self.mapped[key] = np.load(path)
        return self.mapped[key]

    def look_up(self, name: str, value: str, keys: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Values of ascending keys, 0 for those that are not there; ``part`` of each key."""
        found = np.zeros(len(keys))
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(self.parts + 1))
        for p in range(self.parts):
            own = order[cuts[p] : cuts[p + 1]]
            stored = self.array(name, p)
            if len(own) and len(stored):
                at = np.minimum(np.searchsorted(stored, keys[own]), len(stored) - 1)
                hit = stored[at] == keys[own]
                found[own[hit]] = self.array(value, p)[at[hit]]
        return found


def _discounts(n: list[int]) -> list[float]:
    """The three discounts from how many things were counted 1, 2, 3 and 4 times."""
    if not n[0] or not n[1]:
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 2.0]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]


def _by_count(discounts: list[float], counts: np.ndarray) -> np.ndarray:
    return np.array([0.0, *discounts])[np.minimum(counts, 3).astype(np.int64)]


def _rows(names: str, kinds: list, rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names.split())


def _count_words(parts: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in texts.blocks(batches, size=COUNT_BLOCK):
            keys, counts = np.unique(tokens(block)[0], return_counts=True)
            cuts = np.searchsorted(_part_of(keys, parts), np.arange(parts + 1, dtype=np.uint64))
            rows = [(p, texts.pack_sorted(keys[a:b]), texts.pack(counts[a:b])) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            yield _rows("part keys counts", [pa.int32(), pa.binary(), pa.binary()], rows)

    return count


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([texts.unpack_sorted(x.as_py()) for x in table["keys"]])
    return _summed(keys, np.concatenate([texts.unpack(x.as_py()) for x in table["counts"]]).astype(np.int64))


def _store_words(folder: str):
    def store(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        keys, counts = _merged(table)
        _save(folder, "word", part, keys)
        _save(folder, "count", part, counts)
        frequent = np.flatnonzero((counts >= HOT_SHARE * counts.sum()) & (keys != END))
        return pa.table({
            "part": pa.array([part], pa.int32()), "types": pa.array([len(keys)], pa.int64()), "total": pa.array([counts.sum()], pa.int64()),
            "hot": pa.array([keys[frequent].view(np.int64).tolist()], pa.list_(pa.int64())),
            "hot_counts": pa.array([counts[frequent].tolist()], pa.list_(pa.int64())),
        })

    return store


def _bigram_part(before: np.ndarray, word: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    at = np.minimum(np.searchsorted(hot, before), max(len(hot) - 1, 0))
    is_hot = hot[at] == before if len(hot) else np.zeros(len(before), bool)
    return _part_of(np.where(is_hot, _keys(before, word), texts.mix(before)), parts)


def _count_bigrams(parts: int, hot: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in texts.blocks(batches, size=COUNT_BLOCK):
            words, first = tokens(block)
            before, short = _before(words, first), _short(words)
            keys, at, counts = np.unique(_keys(before, short), return_index=True, return_counts=True)
            before, short = before[at], short[at]
            order = np.lexsort((short, before, _bigram_part(before, short, hot, parts)))
            before, short, counts = before[order], short[order], counts[order]
            cuts = np.searchsorted(_bigram_part(before, short, hot, parts), np.arange(parts + 1, dtype=np.uint64))
            rows = [
                (p, texts.pack_sorted(before[a:b]), short[a:b].astype("<u4").tobytes(), texts.pack(counts[a:b]))
                for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a
            ]
            yield _rows("part before words counts", [pa.int32(), pa.binary(), pa.binary(), pa.binary()], rows)

    return count


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _store_bigrams(folder: str, parts: int, hot: np.ndarray):
    def store(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        before = np.concatenate([texts.unpack_sorted(x.as_py()) for x in table["before"]])
        short = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table["words"]]).astype(np.uint64)
        counts = np.concatenate([texts.unpack(x.as_py()) for x in table["counts"]]).astype(np.int64)
        keys = _keys(before, short)
        order = np.argsort(keys)
        keys, before, short, counts = keys[order], before[order], short[order], counts[order]
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts, keys, before, short = np.add.reduceat(counts, heads), keys[heads], before[heads], short[heads]
        _save(folder, "bigram", part, keys)
        _save(folder, "bigram_count", part, counts.astype(np.uint32))
        # How many continuations of each first word were seen once, twice, and more often.
        contexts, place = np.unique(before, return_inverse=True)
        kinds = np.stack([np.bincount(place, weights=hit, minlength=len(contexts)) for hit in (counts == 1, counts == 2, counts >= 3)], 1).astype(np.int64)
        is_hot = np.isin(contexts, hot)
        _save(folder, "context", part, contexts[~is_hot])
        _save(folder, "context_kinds", part, kinds[~is_hot].astype(np.uint32))
        # How many different words stand before each word, as far as this range knows.
        after, preceded = np.unique(short, return_counts=True)
        cuts = np.searchsorted(_part_of(after << np.uint64(32), parts), np.arange(parts + 1, dtype=np.uint64))
        mine = [(p, texts.pack_sorted(after[a:b]), texts.pack(preceded[a:b])) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        n = len(mine)
        blank = [None] * max(n - 1, 0)
        facts = [_counts_of_counts(counts), contexts[is_hot].view(np.int64).tolist(), kinds[is_hot].ravel().tolist()]
        return pa.table({
            "part": pa.array([x[0] for x in mine], pa.int32()), "keys": pa.array([x[1] for x in mine], pa.binary()), "counts": pa.array([x[2] for x in mine], pa.binary()),
            "types": pa.array([len(keys), *blank], pa.int64()), "own": pa.array([part, *blank], pa.int32()), **{k: pa.array([v, *blank], pa.list_(pa.int64())) for k, v in zip(("seen", "hot", "hot_kinds"), facts, strict=True)},
        })

    return store


def _store_followers(folder: str):
    def store(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        keys, counts = _merged(table)
        _save(folder, "follower", part, keys)
        _save(folder, "follower_count", part, counts)
        kinds = [int((counts == 1).sum()), int((counts == 2).sum()), int((counts >= 3).sum())]
        return pa.table({"own": pa.array([part], pa.int32()), "seen": pa.array([_counts_of_counts(counts)], pa.list_(pa.int64())), "kinds": pa.array([kinds], pa.list_(pa.int64()))})

    return store


def _total(rows: list, name: str, size: int) -> list[int]:
    return np.sum([r[name] for r in rows], axis=0).astype(int).tolist() if rows else [0] * size


def fit(training: DataFrame) -> Model:
    """The model of all texts of ``training (text)``; its arrays stay in the shared folder."""
    spark = training.sparkSession
    folder = local_path(scratch_path(spark, "kneser-ney"))
    rows = training.selectExpr("cast(text as string) as text")
    starts, total = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = ranges_for(spark, total or 0)
    words = rows.mapInArrow(_count_words(parts), "part int, keys binary, counts binary").groupBy("part").applyInArrow(
        _store_words(folder), "part int, types bigint, total bigint, hot array<bigint>, hot_counts array<bigint>"
    )
    words = words.collect()  # a row of totals per range; of its words only those that hold HOT_SHARE of it
    total, types = sum(r.total for r in words), sum(r.types for r in words)
    hot = [h for r in words for h, c in zip(r.hot, r.hot_counts, strict=True) if c >= HOT_SHARE * total]
    hot = np.unique(np.concatenate([np.array(hot, np.int64).view(np.uint64), [START]]))
    bigrams = rows.mapInArrow(_count_bigrams(parts, hot), "part int, before binary, words binary, counts binary").groupBy("part").applyInArrow(
        _store_bigrams(folder, parts, hot),
        "part int, keys binary, counts binary, types bigint, own int, seen array<bigint>, hot array<bigint>, hot_kinds array<bigint>",
    )
    bigrams = written(bigrams, "followers")
    facts = bigrams.where("types is not null").select("types", "own", "seen", "hot", "hot_kinds").collect()
    discounts = _discounts(_total(facts, "seen", 4))
    followers = bigrams.select("part", "keys", "counts").groupBy("part").applyInArrow(_store_followers(folder), "own int, seen array<bigint>, kinds array<bigint>")
    followers = followers.collect()
    low = _discounts(_total(followers, "seen", 4))
    free = np.zeros(len(hot))
    for r in facts:
        at = np.searchsorted(hot, np.array(r.hot, np.int64).view(np.uint64))
        np.add.at(free, at, np.array(r.hot_kinds, float).reshape(-1, 3) @ np.array(discounts))
    ranges = {"word": words, "count": words, "follower": followers, "follower_count": followers}
    ranges |= dict.fromkeys(("bigram", "bigram_count", "context", "context_kinds"), facts)
    have = {name: frozenset(r["part" if found is words else "own"] for r in found) for name, found in ranges.items()}
    return Model(
        folder, parts, total, types, discounts, low, sum(r.types for r in facts),
        float(np.dot(_total(followers, "kinds", 3), low)), hot, free, starts, have,
    )


def _score(model: Model, block: texts.Block) -> dict[str, np.ndarray]:
    words, first = tokens(block)
    types, place = np.unique(words, return_inverse=True)
    count = model.look_up("word", "count", types, _part_of(types, model.parts))
    base = np.log10((count + 1) / (model.train_tokens + model.types + 1))

    shorts = _short(types)
    order = np.argsort(shorts)
    preceded = np.empty(len(types))
    preceded[order] = model.look_up("follower", "follower_count", shorts[order], _part_of(shorts[order] << np.uint64(32), model.parts))
    uniform = 1 / (model.types + 1)
    pairs_seen = max(model.bigram_types, 1)
    free = model.low_free / pairs_seen if model.bigram_types else 1.0
    low = np.maximum(preceded - _by_count(model.low_discounts, preceded), 0) / pairs_seen + free * uniform

    before = _before(words, first)
    keys, at, back = np.unique(_keys(before, _short(words)), return_index=True, return_inverse=True)
    part = _bigram_part(before[at], _short(words[at]), model.hot, model.parts).astype(np.int64)
    pair = model.look_up("bigram", "bigram_count", keys, part)
    gain = np.maximum(pair - _by_count(model.discounts, pair), 0)[back]

    # Of each first word: how often it begins a bigram, and what the discounts free.
    contexts = np.concatenate([[START], types])
    begun = np.concatenate([[model.starts], count])
    order = np.argsort(contexts)
    ranked = contexts[order]
    freed = np.zeros(len(contexts))
    context_part = _part_of(texts.mix(ranked), model.parts)
    for p in np.unique(context_part):
        own = np.flatnonzero(context_part == p)
        stored, kinds = model.array("context", int(p)), model.array("context_kinds", int(p))
        if len(stored):
            spot = np.minimum(np.searchsorted(stored, ranked[own]), len(stored) - 1)
            hit = stored[spot] == ranked[own]
            freed[order[own[hit]]] = np.asarray(kinds[spot[hit]], float) @ np.array(model.discounts)
    spot = np.minimum(np.searchsorted(model.hot, contexts), len(model.hot) - 1)
    hit = model.hot[spot] == contexts
    freed[hit] = model.hot_free[spot[hit]]
    of = np.empty(len(words), np.int64)
    of[1:] = place[:-1] + 1
    of[first[:-1]] = 0
    n = begun[of]
    p = np.where(n > 0, (gain + freed[of] * low[place]) / np.maximum(n, 1), low[place])
    logs = np.log10(np.maximum(p, 1e-30))
    per_text = lambda x: np.add.reduceat(x, first[:-1]) if len(first) > 1 else np.zeros(0)  # noqa: E731  every text has its end
    return {
        "n_tokens": np.diff(first),
        "n_known": texts.sums(count[place] > 0, first),
        "train_tokens": np.full(len(block), model.train_tokens),
        "base_score": per_text(base[place]),
        "score": per_text(logs),
    }


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Token counts and log10 probabilities per row of ``documents (doc_id, text)``; ``perplexity`` follows from them."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block in texts.blocks(batches):
            values = _score(model, block)
            values["perplexity"] = 10 ** np.minimum(-values["score"] / values["n_tokens"], 300)
            yield pa.RecordBatch.from_arrays([rows["doc_id"], *map(pa.array, values.values())], ["doc_id", *values])

    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    schema = "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double"
    return rows.mapInArrow(scored, schema)
