"""Languages of a text as a mixture, by expectation-maximisation over n-gram likelihoods.

A text's byte trigrams are drawn from a mixture of the languages' trigram distributions; EM finds
the proportions that make the text likeliest. The set of languages is the one of the nested sets
(likeliest language alone, the two largest, and so on up to all) with the best log likelihood less a
penalty for each language, and the prediction is its largest member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm import text as T

#: Buckets of trigrams.
BUCKETS = 1 << 13
#: Texts handled at once; also bounds the matrix of their counts.
ROWS = 512
#: Numbers held at once for trigrams by languages.
CELLS = 1 << 22
SMOOTHING = 0.5
ROUNDS = 15
#: Log likelihood a further language must add, for each trigram of the text (natural log).
PENALTY = 0.02
UNKNOWN = "und"
#: Log likelihood of a trigram if all buckets are equally likely.
CHANCE = -float(np.log(BUCKETS))
#: Part of what held-out text of a language gains over chance that a text in it must gain.
LEAST_GAIN = 0.25
#: Standard errors of a text's mean that are allowed for, so that short texts are not judged hastily.
ERRORS = 3.0


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each trigram, and its text. Letters only; other bytes count as one space each."""
    data, offsets = T.raw(column)
    data = np.where(_NO_LETTER[data], np.uint8(0x20), T.LOWER[data])
    n, texts = len(data), len(offsets) - 1
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    padded = np.full(n + 2 * texts, 0x20, np.uint8)
    padded[np.arange(n) + 2 * owner + 1] = data
    whose = np.repeat(np.arange(texts), np.diff(offsets) + 2)
    if len(padded) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, c = padded[:-2].astype(np.uint32), padded[1:-1], padded[2:]
    good = (whose[:-2] == whose[2:]) & ((a != 0x20) | (b != 0x20) | (c != 0x20))
    code = (a << np.uint32(16) | b.astype(np.uint32) << np.uint32(8) | c)[good]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    return bucket.astype(np.int64), whose[:-2][good]


#: Bytes that are no ASCII letter and no part of another character.
_NO_LETTER = T.table([range(0x00, 0x41), range(0x5B, 0x61), range(0x7B, 0x80)])


def counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, buckets and numbers of the trigrams that occur, in order of the texts."""
    bucket, owner = features(column)
    table = np.bincount(owner * BUCKETS + bucket, minlength=len(column) * BUCKETS)
    where = np.flatnonzero(table)
    return where // BUCKETS, where % BUCKETS, table[where]


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in T.chunks(batch, "_body"):
            for at in range(0, part.num_rows, ROWS):
                yield part.slice(at, ROWS)


def learn(
    documents: DataFrame, text: str = "text", lang: str = "lang"
) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log probability of each bucket in each of them.

    Counts every trigram of every row that has a text and a language. The result has a number for
    each bucket and language, whatever the size of the corpus.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def told() -> pa.RecordBatch:
            rows = [(k, np.flatnonzero(v), v) for k, v in sums.items()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, at, _ in rows for _ in range(len(at))], pa.string()),
                    pa.array(np.concatenate([at for _, at, _ in rows]), pa.int32()),
                    pa.array(np.concatenate([v[at] for _, at, v in rows]), pa.int64()),
                ],
                names=["lang", "bucket", "n"],
            )

        for rows in small(batches):
            bucket, owner = features(rows.column("_body"))
            codes = rows.column("lang").dictionary_encode()
            mine = codes.indices.to_numpy()[owner]
            names = codes.dictionary.to_pylist()
            table = np.bincount(mine * BUCKETS + bucket, minlength=len(names) * BUCKETS)
            for k, name in enumerate(names):
                part = table[k * BUCKETS : (k + 1) * BUCKETS]
                sums[name] = sums[name] + part if name in sums else part
            if len(sums) >= 256:
                yield told()
                sums.clear()
        if sums:
            yield told()

    rows = (
        documents.select(
            F.col(text).cast("string").alias("_body"), F.col(lang).cast("string").alias("lang")
        )
        .where("_body is not null and lang is not null")
        .mapInArrow(work, "lang STRING, bucket INT, n BIGINT")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    per_language = rows.groupBy("lang").agg(
        F.collect_list(F.struct("bucket", "n")).alias("counts")
    )
    found = sorted(per_language.collect(), key=lambda r: r.lang)
    table = np.full((BUCKETS, max(1, len(found))), SMOOTHING)
    for k, row in enumerate(found):
        for bucket, n in row.counts:
            table[bucket, k] += n
    return [r.lang for r in found], np.log(table / table.sum(axis=0))


def proportions(
    likely: np.ndarray, n: np.ndarray, starts: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """EM for several texts at once: proportions of each, and log likelihoods.

    likely: a row for each trigram of each text, a column for each language; n: how often it occurs;
    starts: first trigram of each text; start: proportions to begin with (zero stays zero).
    """
    share = start
    total = np.add.reduceat(n, starts)
    sizes = np.diff(np.append(starts, len(n)))
    for _ in range(ROUNDS):
        each = np.einsum("ij,ij->i", likely, np.repeat(share, sizes, axis=0))
        share = share * np.add.reduceat(likely * (n / each)[:, None], starts) / total[:, None]
    each = np.einsum("ij,ij->i", likely, np.repeat(share, sizes, axis=0))
    return share, np.add.reduceat(n * np.log(each), starts)


def decide(
    log_likely: np.ndarray,
    n: np.ndarray,
    starts: np.ndarray,
    penalty: float,
    set_size: int | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: proportions over all languages, proportions over its set, the prediction.

    Larger sets are tried while any mixture at all could still be worth their penalty; set_size is
    the most languages of a set, None for all.
    """
    texts, languages = len(starts), log_likely.shape[1]
    total = np.add.reduceat(n, starts)
    alone = np.add.reduceat(log_likely * n[:, None], starts)
    likely = np.exp(log_likely - log_likely.max(axis=1, keepdims=True))
    offset = np.add.reduceat(n * log_likely.max(axis=1), starts)
    full, most = proportions(likely, n, starts, np.full((texts, languages), 1 / languages))
    sizes = np.diff(np.append(starts, len(n)))
    each = np.einsum("ij,ij->i", likely, np.repeat(full, sizes, axis=0))
    slope = np.add.reduceat(likely * (n / each)[:, None], starts).max(axis=1) / total
    # no mixture is likelier: by Jensen, it gains at most the logarithm of the steepest slope
    most = most + offset + total * np.log(np.maximum(slope, 1)) + 1e-9 * np.abs(offset)
    best = np.zeros((texts, languages))
    best[np.arange(texts), alone.argmax(axis=1)] = 1
    value = alone.max(axis=1) - penalty * total
    order = np.argsort(-full, axis=1, kind="stable")
    going = np.arange(texts)
    for k in range(2, min(set_size or languages, languages) + 1):
        still = most[going] - k * penalty * total[going] > value[going]
        if not still.all():
            rows = np.repeat(still, sizes[going])
            likely, n, going = likely[rows], n[rows], going[still]
            starts = np.cumsum(sizes[going]) - sizes[going]
        if not len(going):
            break
        chosen = np.zeros((len(going), languages))
        np.put_along_axis(chosen, order[going, :k], 1 / k, axis=1)
        share, reached = proportions(likely, n, starts, chosen)
        reached = reached + offset[going] - k * penalty * total[going]
        better = reached > value[going]
        best[going[better]], value[going[better]] = share[better], reached[better]
    return full, best, best.argmax(axis=1)


def identify(
    documents: DataFrame,
    model: tuple[list[str], np.ndarray],
    doc_id: str = "doc_id",
    text: str = "text",
    penalty: float = PENALTY,
    set_size: int | None = None,
    keep: tuple[str, ...] = (),
    fit: bool = False,
) -> DataFrame:
    """One row per row of documents: doc_id, the columns of `keep`, lang_pred, score, languages and
    their proportions, and with `fit` also fit and fit_error.

    fit is the mean log likelihood of the text's trigrams under its set, and fit_error its standard
    error; both are null for `und`. The columns
    of `keep` may not have the name of another column of the result. score is the prediction's proportion among all languages. A null text, one without a letter, or
    any text under a model without languages is `und` with score 0 and no languages. Ties between
    languages go to the first by name. Repeated rows are judged each on its own; no documents give
    no rows. Rows map to rows: no shuffle; the model is a bounded table.
    """
    told = ["lang_pred", "score", "languages", "proportions", *(["fit", "fit_error"] if fit else [])]
    T.no_clash(keep, ["doc_id", "_body", "_letter", *told])
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(model)
    chosen = documents.select(
        F.col(doc_id).alias("doc_id"),
        *keep,
        F.col(text).cast("string").alias("_body"),
        F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False)).alias("_letter"),
    )
    names = [c for c in chosen.columns if c not in ("_body", "_letter")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, log_table = sent.value
        for rows in small(batches):
            n_rows = rows.num_rows
            pred, score = [UNKNOWN] * n_rows, np.zeros(n_rows)
            sets: list[list[str]] = [[] for _ in range(n_rows)]
            shares: list[list[float]] = [[] for _ in range(n_rows)]
            fits: list[float | None] = [None] * n_rows
            errors: list[float | None] = [None] * n_rows
            owner, bucket, n = counts(rows.column("_body"))
            letters = rows.column("_letter").to_numpy(zero_copy_only=False)
            use = letters[owner] & bool(languages)
            owner, bucket, n = owner[use], bucket[use], n[use].astype(float)
            step = max(1, CELLS // max(1, len(languages)))
            firsts = np.flatnonzero(np.diff(owner, prepend=-1))
            at = 0
            while at < len(firsts):
                limit = firsts[at] + step
                to = max(at + 1, int(np.searchsorted(firsts, limit, "right")) - 1)
                if len(owner) <= limit:
                    to = len(firsts)
                lo, hi = firsts[at], firsts[to] if to < len(firsts) else len(owner)
                full, best, top = decide(
                    log_table[bucket[lo:hi]], n[lo:hi], firsts[at:to] - lo, penalty, set_size
                )
                for d, f, b, k in zip(owner[firsts[at:to]], full, best, top, strict=True):
                    pred[d], score[d] = languages[k], min(1.0, f[k])
                    mine = sorted(np.flatnonzero(b > 0), key=lambda x, b=b: (-b[x], x))
                    sets[d], shares[d] = [languages[x] for x in mine], [float(b[x]) for x in mine]
                if fit:
                    means = mean_fit(log_table[bucket[lo:hi]], n[lo:hi], firsts[at:to] - lo, best)
                    for d, mean, error in zip(owner[firsts[at:to]], *means, strict=True):
                        fits[d], errors[d] = float(mean), float(error)
                at = to
            yield pa.RecordBatch.from_arrays(
                [
                    *(rows.column(c) for c in names),
                    pa.array(pred, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(sets, pa.list_(pa.string())),
                    pa.array(shares, pa.list_(pa.float64())),
                    *((pa.array(x, pa.float64()) for x in (fits, errors)) if fit else ()),
                ],
                names=[*names, *told],
            )

    return chosen.mapInArrow(
        work,
        T.schema(
            chosen,
            names,
            "lang_pred STRING, score DOUBLE, languages ARRAY<STRING>, proportions ARRAY<DOUBLE>"
            + (", fit DOUBLE, fit_error DOUBLE" if fit else ""),
        ),
    )


def mean_fit(
    log_likely: np.ndarray, n: np.ndarray, starts: np.ndarray, best: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Mean log likelihood of each text's trigrams under the proportions of its set, and its error.

    The error takes the trigrams to spread by one unit at least, so that texts of a few have one.
    """
    sizes, total = np.diff(np.append(starts, len(n))), np.add.reduceat(n, starts)
    each = np.log(np.einsum("ij,ij->i", np.exp(log_likely), np.repeat(best, sizes, axis=0)))
    mean = np.add.reduceat(n * each, starts) / total
    square = np.add.reduceat(n * (each - np.repeat(mean, sizes)) ** 2, starts) / total
    return mean, np.sqrt(np.maximum(square, 1) / total)


def least_fits(
    held_out: DataFrame,
    model: tuple[list[str], np.ndarray],
    text: str = "text",
    lang: str = "lang",
    gain: float = LEAST_GAIN,
) -> dict[str, float]:
    """For each language of the model, the fit below which a text is in no learned language.

    It lies above chance by a part of what held-out texts of the language gain on average. A
    language without such texts takes the mean of all; without any at all the bound is chance.
    Counts every row that has a text and a language of the model; the result has a number for each.
    """
    languages = model[0]
    known = held_out.where(F.col(lang).cast("string").isin(languages) & F.col(text).isNotNull())
    scored = identify(
        known.select(
            F.lit(None).cast("int").alias("doc_id"),
            F.col(text).alias("text"),
            F.col(lang).cast("string").alias("lang"),
        ),
        model,
        keep=("lang",),
        fit=True,
    ).where("fit is not null")
    found = {
        r.lang: (r.fits, r.texts)
        for r in scored.groupBy("lang")
        .agg(F.sum("fit").alias("fits"), F.count(F.lit(1)).alias("texts"))
        .collect()
    }
    fits, texts = (sum(v[k] for v in found.values()) for k in (0, 1))
    usual = fits / texts if texts else CHANCE

    def least(name: str) -> float:
        mean = found[name][0] / found[name][1] if name in found else usual
        return CHANCE + gain * max(0.0, mean - CHANCE)

    return {name: least(name) for name in languages}


def in_a_learned_language(least: dict[str, float], errors: float = ERRORS) -> Column:
    """Whether a row of `identify(..., fit=True)` has a language and does not surely miss its bound.

    Trigrams share buckets, so a text of very few different ones may pass by chance.
    """
    if not least:
        return F.lit(False)
    bound = F.create_map(*(F.lit(x) for pair in sorted(least.items()) for x in pair))
    reached = F.col("fit") + errors * F.col("fit_error")
    return F.coalesce(reached >= F.element_at(bound, F.col("lang_pred")), F.lit(False))

