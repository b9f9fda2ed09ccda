"""Class-based n-gram language model (Brown et al., 1992), clustered by distributed exchange.

A token is predicted by the class of the token before it, then by its own share of its class. The
most frequent words are units of their own from the start; all other words belong to units by their
ending, so every word has a class, seen or not. Units are moved between classes by exchange: tasks
hold parts of the units with their neighbour counts by class, take each unit out of its class and
put it where the likelihood of the class bigrams gains most, as in the distributed version of
Uszkoreit and Brants (2008). Between sweeps all counts are taken anew from the bigrams of the whole
corpus. Every further word of the dictionary is then a unit too: its neighbours are counted by class
over the whole corpus and it is exchanged in the same way. Endings remain for rarer and unseen words.

Words of a text outside the broadcast dictionary are looked up by a join with the full vocabulary,
so no count is left out, whatever the vocabulary's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import text as T
from footfall.session import stage

CLASSES = 64
#: Frequent words that are units from the first sweep on, and units of other words by ending.
OWN_UNITS, ENDINGS = 1 << 13, 1 << 11
#: Words whose counts tasks hold; the others are joined.
DICTIONARY = 1 << 17
SWEEPS = 6
#: Units exchanged in one task, about; parts of the units are exchanged side by side.
PART_UNITS = 2048
#: Added to every count of a word or a unit within its class.
ADDED = 0.5
#: Strength of the class distribution behind class transitions.
BACKOFF = 4.0
#: Bigrams a task adds up before it hands them on.
HELD_PAIRS = 1 << 22
#: The end of a text is a unit and a class of its own, and also what precedes a text.
END = 0


@dataclass
class Dictionary:
    """Hashes of frequent words in order, with their counts and units."""

    hashes: np.ndarray
    counts: np.ndarray
    units: np.ndarray

    def find(self, found: T.Words) -> tuple[np.ndarray, np.ndarray]:
        """Unit of each word, and its count or -1 where the dictionary lacks it."""
        hashed = found.hashes()
        at = np.searchsorted(self.hashes, hashed)
        at[at == len(self.hashes)] = 0
        known = self.hashes[at] == hashed if len(self.hashes) else np.zeros(len(hashed), bool)
        units, counts = endings(found), np.full(len(hashed), -1)
        units[known] = self.units[at[known]]
        counts[known] = self.counts[at[known]]
        return units, counts


def endings(found: T.Words) -> np.ndarray:
    """The unit of each word by its last three bytes."""
    code = np.zeros(len(found), np.uint64)
    for back in (1, 2, 3):
        has = found.ends - found.starts >= back
        code[has] += found.data[found.ends[has] - back].astype(np.uint64) << np.uint64(8 * back)
    return 1 + OWN_UNITS + (T.mix(code) % np.uint64(ENDINGS)).astype(np.int64)


UNITS = 1 + OWN_UNITS + ENDINGS


@dataclass
class Model:
    """A fitted model; `vocabulary` (word, n) stays a stored relation."""

    vocabulary: DataFrame
    dictionary: Dictionary
    classes: np.ndarray  # of each unit
    tokens: int
    texts: int
    types: int
    transitions: np.ndarray  # log10 P(class | class before)
    emissions: np.ndarray  # log10 P(unit | its class)
    ending_sizes: np.ndarray  # log10 of what counts + 0.5 are divided by, for each ending unit

    @property
    def base_size(self) -> float:
        """log10 of what counts + 0.5 are divided by in the base."""
        return float(np.log10(self.tokens + ADDED * (self.types + 1)))


def _bodies(documents: DataFrame, text: str) -> DataFrame:
    return documents.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_body"))


def count_words(documents: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of all texts. The word null stands for the ends of texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.chunks(batch, "_body"):
                found = T.words(part.column("_body"), T.WHITE)
                _, first, n = np.unique(found.hashes(), return_index=True, return_counts=True)
                word = pa.concat_arrays([found.strings(first), pa.nulls(1, pa.string())])
                yield pa.RecordBatch.from_arrays(
                    [word, pa.array(np.append(n, part.num_rows), pa.int64())], names=["word", "n"]
                )

    counted = _bodies(documents, text).mapInArrow(work, "word STRING, n BIGINT")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def code_texts(documents: DataFrame, dictionary: Dictionary, text: str = "text") -> DataFrame:
    """(units): the unit of each word of a text."""
    sent = documents.sparkSession.sparkContext.broadcast(dictionary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.chunks(batch, "_body"):
                found = T.words(part.column("_body"), T.WHITE)
                units, _ = sent.value.find(found)
                column = pa.ListArray.from_arrays(
                    pa.array(found.first, pa.int32()), pa.array(units, pa.int32())
                )
                yield pa.RecordBatch.from_arrays([column], names=["units"])

    return _bodies(documents, text).mapInArrow(work, "units ARRAY<INT>")


def _sequences(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Units of coded texts with their ends put in, and the unit before each."""
    column = batch.column("units")
    first = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
    now, before, _ = sequences(column.flatten().to_numpy(), first.astype(np.int64))
    return now, before


def count_pairs(coded: DataFrame, first: np.ndarray) -> DataFrame:
    """(a, b, n): how often unit b follows unit a, all rows of an `a` in one partition.

    `first` gives the unit in which each unit is counted at first. Pairs are added up before they
    are dealt by `a`, so a unit has a row for each other unit at most.
    """
    sent = coded.sparkSession.sparkContext.broadcast(first)

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(back, np.concatenate([n for _, n in parts])).astype(np.int64)

    def told(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(keys), 1 << 16):
            k = keys[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((k >> 32).astype(np.int32)),
                    pa.array((k & 0xFFFFFFFF).astype(np.int32)),
                    pa.array(n[at : at + (1 << 16)]),
                ],
                names=["a", "b", "n"],
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            now, before = _sequences(batch)
            held.append(
                np.unique((sent.value[before] << 32) | sent.value[now], return_counts=True)
            )
            size += len(held[-1][0])
            if size >= HELD_PAIRS:
                held = [summed(held)]
                size = len(held[0][0])
                if 2 * size >= HELD_PAIRS:
                    yield from told(*held[0])
                    held, size = [], 0
        if held:
            yield from told(*summed(held))

    pairs = coded.mapInArrow(work, "a INT, b INT, n BIGINT")
    return pairs.groupBy("a", "b").agg(F.sum("n").alias("n")).repartition("a")


def sequences(units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of texts with their ends put in, the unit before each, and where each text begins."""
    begin = first + np.arange(len(first))
    now = np.full(begin[-1], END, np.int64)
    inside = np.ones(len(now), bool)
    inside[begin[1:] - 1] = False
    now[inside] = units
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[begin[:-1]] = END
    return now, before, begin


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(
    table: np.ndarray, classes: np.ndarray, after: np.ndarray, before: np.ndarray
) -> np.ndarray:
    """Move units in turn; table[c, d] counts class d after class c and is kept up to date.

    after[u, d] and before[u, d] count the classes after and before unit u.
    """
    classes = classes.copy()
    table = table.astype(float).copy()
    k = len(table)
    every = np.arange(k)
    for u in np.argsort(-after.sum(axis=1), kind="stable"):
        a, b, old = after[u], before[u], classes[u]
        table[old] -= a
        table[:, old] -= b
        np.maximum(table, 0, out=table)
        x, y = np.flatnonzero(a), np.flatnonzero(b)
        gain = (_xlogx(table[:, x] + a[x]) - _xlogx(table[:, x])).sum(axis=1)
        gain += (_xlogx(table[y] + b[y][:, None]) - _xlogx(table[y])).sum(axis=0)
        own = table[every, every]
        gain += _xlogx(own + a + b) - _xlogx(own + a) - _xlogx(own + b) + _xlogx(own)
        rows, columns = table.sum(axis=1), table.sum(axis=0)
        gain -= _xlogx(rows + a.sum()) - _xlogx(rows)
        gain -= _xlogx(columns + b.sum()) - _xlogx(columns)
        gain[END] = -np.inf
        new = old if gain[old] >= gain.max() - 1e-9 else int(gain.argmax())
        table[new] += a
        table[:, new] += b
        classes[u] = new
    return classes


def _larger(batches: Iterator[pa.RecordBatch], rows: int = 1 << 20) -> Iterator[pa.Table]:
    """Batches put together to about so many rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _by_class(pairs: DataFrame, unit: str, other: str, side: int, classes: np.ndarray) -> DataFrame:
    """(part, unit, side, class, n) from bigrams, added up within each task first."""
    k, parts = int(classes.max()) + 1, -(-len(classes) // PART_UNITS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(classes) * k)
        for batch in _larger(batches):
            of = batch.column(unit).to_numpy().astype(np.int64)
            keys = of * k + classes[batch.column(other).to_numpy()]
            sums += np.bincount(keys, batch.column("n").to_numpy(), len(sums))
        keys = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((keys // k % parts).astype(np.int32)),
                pa.array((keys // k).astype(np.int32)),
                pa.array(np.full(len(keys), side, np.int32)),
                pa.array((keys % k).astype(np.int32)),
                pa.array(sums[keys].astype(np.int64)),
            ],
            names=["part", "unit", "side", "class", "n"],
        )

    return pairs.mapInArrow(work, "part INT, unit INT, side INT, class INT, n BIGINT")


def _exchanger(now: np.ndarray, table: np.ndarray):
    """One sweep over the units of a part."""
    classes = len(table)

    def moved(group: pa.Table) -> pa.Table:
        units, at = np.unique(group.column("unit").to_numpy(), return_inverse=True)
        sides = np.zeros((2, len(units), classes))
        side, near = (group.column(c).to_numpy() for c in ("side", "class"))
        np.add.at(sides, (side, at, near), group.column("n").to_numpy())
        free = units != END
        units, sides = units[free], sides[:, free]
        new = exchange(table, now[units], sides[0], sides[1])
        return pa.table({"unit": units.astype(np.int32), "class": new.astype(np.int32)})

    return moved


def cluster(pairs: DataFrame, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of every unit, from a stored relation of bigrams.

    What comes back to the driver is as large as the set of units.
    """
    backward = stage(pairs.repartition("b"), "pairs_by_next")
    now = np.zeros(UNITS, np.int64)
    now[1:] = 1 + np.arange(UNITS - 1) % (classes - 1)
    for _ in range(sweeps):
        both = _by_class(pairs, "a", "b", 0, now).union(_by_class(backward, "b", "a", 1, now))
        table = transition_counts(pairs, now, classes)

        rows = both.groupBy("part").applyInArrow(_exchanger(now, table), "unit INT, class INT").toArrow()
        before = now.copy()
        now[rows.column("unit").to_numpy()] = rows.column("class").to_numpy()
        if (before == now).all():
            break
    return now


def exchange_words(coded: DataFrame, classes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Classes of the words beyond the first units, each exchanged once from the class it has.

    A task adds up the classes next to each of these words in its texts; the rows of a part of the
    words meet in one task, which adds them up as they come and then moves the words in turn.
    """
    sent = coded.sparkSession.sparkContext.broadcast((classes, table))
    k, words = len(table), len(classes) - UNITS
    parts = max(1, -(-words // PART_UNITS))

    def told(sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = np.flatnonzero(sums)
        for at in range(0, len(keys), 1 << 16):
            key = keys[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((key // (2 * k) % parts).astype(np.int32)),
                    pa.array(key),
                    pa.array(sums[key]),
                ],
                names=["part", "key", "n"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, _ = sent.value
        sums = np.zeros(words * 2 * k, np.int32)
        for batch in batches:
            now, before = _sequences(batch)
            at = np.flatnonzero(now >= UNITS)  # the end of its text follows, at least
            word = now[at] - UNITS
            for side, near in ((0, now[at + 1]), (1, before[at])):
                key, n = np.unique((word * 2 + side) * k + classes[near], return_counts=True)
                sums[key] += n.astype(np.int32)
            if len(at) and sums.max() > 1 << 30:
                yield from told(sums)
                sums[:] = 0
        yield from told(sums)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, table = sent.value
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            part, key = batch.column("part").to_numpy(), batch.column("key").to_numpy()
            n = batch.column("n").to_numpy()
            for p in np.unique(part):
                mine = part == p
                if p not in held:
                    held[p] = np.zeros((-(-words // parts), 2, k))
                word, rest = np.divmod(key[mine], 2 * k)
                np.add.at(held[p], (word // parts, rest // k, rest % k), n[mine])
        for p, sides in held.items():
            word = np.arange(p, words, parts)
            sides = sides[: len(word)]
            new = exchange(table, classes[UNITS + word], sides[:, 0], sides[:, 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(word.astype(np.int32)), pa.array(new.astype(np.int32))], names=["word", "class"]
            )

    counted = coded.mapInArrow(count, "part INT, key BIGINT, n INT")
    moved = counted.repartition(parts, "part").mapInArrow(move, "word INT, class INT").toArrow()
    out = classes[UNITS:].copy()
    out[moved.column("word").to_numpy()] = moved.column("class").to_numpy()
    return out


def class_pairs(coded: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    """How often a class follows another in all texts."""
    sent = coded.sparkSession.sparkContext.broadcast(classes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k * k, np.int64)
        for batch in batches:
            now, before = _sequences(batch)
            sums += np.bincount(sent.value[before] * k + sent.value[now], minlength=k * k)
        keys = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.astype(np.int32)), pa.array(sums[keys])], names=["key", "n"]
        )

    return _table(coded.mapInArrow(work, "key INT, n BIGINT"), k)


def _table(rows: DataFrame, k: int) -> np.ndarray:
    out = np.zeros(k * k)
    for row in rows.groupBy("key").agg(F.sum("n").alias("n")).collect():
        out[row.key] = row.n
    return out.reshape(k, k)


def transition_counts(pairs: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    """How often a class follows another."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k * k)
        for batch in batches:
            a, b = (classes[batch.column(c).to_numpy()] for c in ("a", "b"))
            sums += np.bincount(a * k + b, batch.column("n").to_numpy(), k * k)
        keys = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.astype(np.int32)), pa.array(sums[keys].astype(np.int64))],
            names=["key", "n"],
        )

    return _table(pairs.mapInArrow(work, "key INT, n BIGINT"), k)


def fit(
    documents: DataFrame,
    text: str = "text",
    classes: int = CLASSES,
    sweeps: int = SWEEPS,
    dictionary_size: int = DICTIONARY,
) -> Model:
    """Learn from all rows. Null texts are empty texts: they have an end and nothing else."""
    counted = stage(count_words(documents, text), "vocabulary")
    vocabulary = counted.where("word is not null")
    texts = counted.where("word is null").agg(F.sum("n")).first()[0] or 0
    tokens = counted.agg(F.sum("n")).first()[0] or 0
    types = counted.count() if texts else 0

    top = vocabulary.orderBy(F.desc("n"), "word").limit(dictionary_size).toArrow()
    found = T.words(top.column("word").combine_chunks(), T.WHITE)
    hashed, units = found.hashes(), endings(found)
    own = min(OWN_UNITS, len(hashed))
    units[:own] = 1 + np.arange(own)
    order = np.argsort(hashed)
    counts = top.column("n").to_numpy()
    first = np.concatenate([np.arange(UNITS), units[own:]])  # further words are counted by ending
    units[own:] = UNITS + np.arange(len(hashed) - own)
    dictionary = Dictionary(hashed[order], counts[order], units[order])

    coded = stage(code_texts(documents, dictionary, text), "coded")
    pairs = stage(count_pairs(coded, first), "pairs")
    assigned = cluster(pairs, classes, sweeps)
    table = transition_counts(pairs, assigned, classes)
    if len(hashed) > own:
        of_words = exchange_words(coded, assigned[first], table)
        assigned = np.concatenate([assigned, of_words])
        table = class_pairs(coded, assigned, classes)

    # counts of units, and of tokens and types that belong to each ending
    ending_types, ending_tokens = _by_ending(vocabulary, top)
    unit_counts = np.zeros(len(assigned))
    unit_counts[END] = texts
    unit_counts[1 + OWN_UNITS : UNITS] = ending_tokens
    unit_counts[units] = counts
    return Model(
        vocabulary,
        dictionary,
        assigned,
        int(tokens),
        int(texts),
        int(types),
        *_probabilities(table, unit_counts, assigned, classes),
        np.log10(ending_tokens + ADDED * (ending_types + 1)),
    )


def _by_ending(vocabulary: DataFrame, top: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Different words and tokens of each ending unit: the vocabulary's less the dictionary's."""

    def added(words: pa.Array, n: np.ndarray) -> np.ndarray:
        unit = endings(T.words(words, T.WHITE)) - 1 - OWN_UNITS
        return np.stack([np.bincount(unit, w, ENDINGS) for w in (None, n)]).astype(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, ENDINGS), np.int64)
        for batch in batches:
            sums += added(batch.column("word"), batch.column("n").to_numpy())
        keys = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.astype(np.int32)), pa.array(sums[0, keys]), pa.array(sums[1, keys])],
            names=["ending", "types", "tokens"],
        )

    out = np.zeros((2, ENDINGS))
    rows = vocabulary.mapInArrow(work, "ending INT, types BIGINT, tokens BIGINT")
    for row in rows.groupBy("ending").agg(F.sum("types").alias("a"), F.sum("tokens").alias("b")).collect():
        out[:, row.ending] = row.a, row.b
    if len(top):
        out -= added(top.column("word").combine_chunks(), top.column("n").to_numpy())
    return out[0], out[1]


def _probabilities(
    table: np.ndarray, unit_counts: np.ndarray, assigned: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """log10 of class transitions and of units within their class."""
    sizes = np.bincount(assigned, unit_counts, k)
    overall = (sizes + ADDED) / (sizes.sum() + ADDED * k)
    transitions = (table + BACKOFF * overall) / (table.sum(axis=1, keepdims=True) + BACKOFF)
    members = np.bincount(assigned, minlength=k)
    emissions = (unit_counts + ADDED) / (sizes + ADDED * members)[assigned]
    return np.log10(transitions), np.log10(emissions)


def score(
    documents: DataFrame,
    model: Model,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of documents: doc_id, the columns of `keep`, n_tokens, n_known,
    train_tokens, base_score, score.

    Both scores are log10 probabilities of the whole text, its end included; perplexity is
    10 ** (-score / n_tokens). A null or empty text is an end alone. Repeated rows are scored each
    on its own; no documents give no rows; without training rows all words are unknown.
    """
    sent = documents.sparkSession.sparkContext.broadcast(
        (
            model.dictionary,
            model.classes,
            model.transitions,
            model.emissions,
            model.ending_sizes,
            model.texts,
            model.base_size,
        )
    )
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_body")
    chosen = documents.select(F.col(doc_id).alias("doc_id"), *keep, body)
    names = [c for c in chosen.columns if c != "_body"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, classes, transitions, emissions, ending_sizes, texts, base_size = sent.value
        for batch in batches:
            for rows in T.chunks(batch, "_body"):
                found = T.words(rows.column("_body"), T.WHITE)
                units, counts = dictionary.find(found)
                now, before, begin = sequences(units, found.first)
                seen, _, _ = sequences(counts, found.first)
                seen[begin[1:] - 1] = texts
                asked = seen < 0  # the vocabulary knows
                given = np.where(asked, 1.0, seen + ADDED)
                base = np.where(asked, 0.0, np.log10(given)) - base_size
                value = transitions[classes[before], classes[now]] + emissions[now]
                by_end = (now > OWN_UNITS) & (now < UNITS)
                value[by_end] -= ending_sizes[now[by_end] - 1 - OWN_UNITS]
                value[by_end & ~asked] += np.log10(given[by_end & ~asked])
                # words to look up, each once for a text
                at = np.flatnonzero(counts < 0)
                owner = found.owner()[at]
                order = np.lexsort((found.hashes()[at], owner))
                at, owner, hashed = at[order], owner[order], found.hashes()[at[order]]
                new = np.ones(len(at), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
                firsts = np.flatnonzero(new)
                times = np.diff(np.append(firsts, len(at)))
                offsets = np.searchsorted(owner[firsts], np.arange(found.texts + 1))
                words = pa.StructArray.from_arrays(
                    [found.strings(at[firsts]), pa.array(times, pa.int64())], ["word", "n"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(c) for c in names),
                        pa.array(np.diff(begin), pa.int64()),
                        pa.array(T.per_text(seen > 0, begin), pa.int64()),
                        pa.array(T.per_text(base, begin)),
                        pa.array(T.per_text(value, begin)),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words),
                    ],
                    names=[*names, "n_tokens", "n_known", "base_score", "score", "asked"],
                )

    part = stage(
        chosen.mapInArrow(
            work,
            T.schema(
                chosen,
                names,
                "n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE, "
                "asked ARRAY<STRUCT<word: STRING, n: BIGINT>>",
            ),
        ).withColumn("_row", F.monotonically_increasing_id()),
        "scored",
    )
    asked = part.select("_row", F.explode("asked").alias("w")).select("_row", "w.word", "w.n")
    vocabulary = model.vocabulary.withColumnRenamed("n", "count")
    count = F.coalesce("count", F.lit(0))
    told = (
        asked.join(vocabulary, "word", "left")
        .groupBy("_row")
        .agg(
            F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("_known"),
            F.sum(F.col("n") * F.log10(count + ADDED)).alias("_log"),
        )
    )
    more = F.coalesce("_log", F.lit(0.0))
    return part.drop("asked").join(told, "_row", "left").select(
        *names,
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
