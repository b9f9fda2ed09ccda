"""Each operator against a plain version, and on awkward rows."""

import math
import textwrap
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from footfall.llm import (
    blocks,
    brown,
    components,
    decontaminate,
    frames,
    languages,
    licenses,
    pieces,
    quality,
    shards,
    simhash,
    vectors,
)
from footfall.session import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SENTENCE = "the quick brown fox jumps over the lazy dog while seven small birds watch it closely"
GERMAN = "der schnelle braune Fuchs springt über den faulen Hund und sieben Vögel sehen ihm zu"
ODD = [
    (1, SENTENCE),
    (2, SENTENCE),
    (2, SENTENCE),
    (None, SENTENCE + " now"),
    (None, None),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "..."),
    (7, GERMAN),
    (8, (SENTENCE + ". " + GERMAN + "\n") * 400),
    (9, "a"),
    (10, "日本語 \x00 ▁ <s> <|endoftext|> é́ 🙂"),
]


@pytest.fixture(scope="module")
def odd(llm):
    """Null ids and texts, repeats, empty and long texts, and columns with names used inside."""
    rows = [(i, t, "x", 1, 2, "y") for i, t in ODD]
    return llm.createDataFrame(
        rows, "doc_id BIGINT, text STRING, score STRING, _body INT, _row INT, number STRING"
    ).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def rows(df, *columns):
    return sorted(
        (tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr
    )


def expected(values):
    return sorted(map(tuple, values), key=repr)


# --- decontamination ------------------------------------------------------------------------

BENCHMARK = [
    (1, SENTENCE),
    (2, GERMAN),
    (3, "a"),
    (4, "lazy dog"),
    (5, SENTENCE),
    (6, None),
    (7, "..."),
    (None, "quick"),
    (None, " ".join(GERMAN.split()[1:])),
    (8, "quick"),
]


@pytest.mark.parametrize("block", [200_000, 3])
def test_decontamination_matches_plain_search(llm, odd, none, block):
    benchmark = llm.createDataFrame(BENCHMARK, "item_id BIGINT, text STRING")

    def run(docs, items):
        found = decontaminate.find_benchmark(docs, items, block_patterns=block)
        return rows(
            found,
            "doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("bigint"),
            F.sha2(F.array_join("items", ","), 256),
            decontaminate.contaminated(),
        )

    assert run(odd, benchmark) == expected(brute.decontaminated(ODD, BENCHMARK))
    assert run(none, benchmark) == []
    assert run(odd, benchmark.where("false")) == expected(brute.decontaminated(ODD, []))


def test_shift_table_search_finds_every_place():
    random = np.random.default_rng(5)
    words = [str(x) for x in random.integers(0, 4, 3000)]
    for length in (1, 2, 5, 13):
        wanted = {tuple(words[k : k + length]) for k in random.integers(0, 2900, 6)}
        patterns = [" ".join(p).encode() for p in sorted(wanted)]
        table = decontaminate.Patterns(length, patterns, [[str(k)] for k in range(len(patterns))])
        import pyarrow as pa

        from footfall.llm import text as T

        found = T.words(pa.array([" ".join(words), "0 1", None]), T.NOT_ALNUM)
        ends, _ = table.search(found, found.hashes())
        plain = {
            k + length - 1
            for k in range(len(words) - length + 1)
            if tuple(words[k : k + length]) in wanted
        }
        if length > 2:
            assert set(ends.tolist()) == plain
        assert len(set(ends.tolist())) == len(ends)


# --- SimHash --------------------------------------------------------------------------------


def test_class_scores_match_a_plain_model(llm):
    """Scores from the fitted word classes, counted anew in plain Python."""
    random = np.random.default_rng(6)
    own, more = brown.OWN_UNITS, 60
    words = [f"w{x}{'ab'[x % 2]}" for x in range(own + 200)]
    texts = [" ".join(random.choice(words, random.integers(0, 300))) for _ in range(300)]
    train = llm.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING")
    model = brown.fit(train, classes=5, sweeps=1, dictionary_size=own + more)

    units, counts = {}, Counter(w for t in texts for w in brute.white_words(t))
    import pyarrow as pa

    from footfall.llm import text as T

    asked = [*words, "unseen", "other words"]
    for word in {x for t in asked for x in t.split()}:
        units[word] = int(model.dictionary.find(T.words(pa.array([word]), T.WHITE))[0][0])
    classes = model.classes
    in_dictionary = [w for w in words if units[w] <= own or units[w] >= brown.UNITS]
    assert len(in_dictionary) == own + more and len(classes) == brown.UNITS + more
    assert len({units[w] for w in in_dictionary}) == own + more
    assert len(set(classes[brown.UNITS :].tolist())) > 1

    table, sizes, of_unit = Counter(), Counter(), Counter()
    for t in texts:
        now = [*(units[w] for w in brute.white_words(t)), brown.END]
        table.update((classes[a], classes[b]) for a, b in zip([brown.END, *now], now))
        of_unit.update(now)
    for unit, n in of_unit.items():
        sizes[classes[unit]] += n
    members = Counter(classes.tolist())
    all_tokens = sum(of_unit.values())

    def score(text):
        total, before = 0.0, 0
        listed = brute.white_words(text)
        for word, unit in zip([*listed, None], [*(units[w] for w in listed), brown.END], strict=True):
            c = classes[unit]
            share = (sizes[c] + 0.5) / (all_tokens + 0.5 * 5)
            row = sum(table[before, d] for d in range(5))
            total += math.log10((table[before, c] + 4 * share) / (row + 4))
            total += math.log10((of_unit[unit] + 0.5) / (sizes[c] + 0.5 * members[c]))
            if own < unit < brown.UNITS:
                types = sum(units[w] == unit and counts[w] > 0 for w in words)
                total += math.log10((counts[word] + 0.5) / (of_unit[unit] + 0.5 * (types + 1)))
            before = c
        return total

    held = ["", "w1b w2a unseen w2a", " ".join(words[-300:]), "other words w39b", texts[0]]
    df = llm.createDataFrame([(i, t) for i, t in enumerate(held)], "doc_id BIGINT, text STRING")
    got = {r.doc_id: r.score for r in brown.score(df, model).collect()}
    assert got == pytest.approx({i: score(t) for i, t in enumerate(held)}, abs=1e-9)


def test_simhash_groups_match_all_pairs(llm, none):
    random = np.random.default_rng(1)
    base = [" ".join(f"w{x}" for x in random.integers(0, 5000, 300)) for _ in range(12)]
    texts = [None, "", "one", "one two", "one two three", *base]
    for t in base:
        words = t.split()
        for n in (1, 2, 4):
            changed = words.copy()
            for at in random.integers(0, 300, n):
                changed[at] = "new"
            texts.append(" ".join(changed).upper())
    docs = [(k * 3, t) for k, t in enumerate(texts)]
    df = llm.createDataFrame(docs, "doc_id BIGINT, text STRING")
    for cell_rows in (8192, 4):
        got = simhash.near_duplicates(df, cell_rows=cell_rows)
        assert rows(got, "doc_id", "fingerprint", "component_id") == expected(
            brute.near_duplicates(docs)
        )
    assert rows(simhash.near_duplicates(none)) == []


def test_simhash_odd_rows(odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {3}
    assert Counter(r.doc_id for r in got)[2] == 2


def test_links_at_exactly_three_bits(llm):
    a = 0x0123456789ABCDEF
    prints = [a, a ^ 0b111, a ^ (0b1111 << 40), a ^ (1 << 63), a ^ (1 << 63) ^ (0b11 << 20)]
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    got = {tuple(r) for r in simhash.links(llm.createDataFrame(signed, "fp BIGINT")).collect()}
    tied = brute.components(
        list(range(5)), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3
    )
    edges = llm.createDataFrame(list(got), "a BIGINT, b BIGINT")
    members = {r.node: r.component for r in components.components(edges).collect()}
    for i in range(5):
        for j in range(5):
            x, y = members.get(signed[i][0], signed[i][0]), members.get(signed[j][0], signed[j][0])
            assert (tied[i] == tied[j]) == (x == y)


def test_components_of_a_path_a_star_and_loops(llm):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)]
    edges += [(200, 200), (300, 299), (299, 300)]
    got = components.components(llm.createDataFrame(edges, "a BIGINT, b BIGINT"))
    plain = dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 130), 100)
    plain |= {299: 299, 300: 299}
    assert {r.node: r.component for r in got.collect()} == plain


def test_block_pairs_bring_any_two_rows_together(llm):
    df = llm.createDataFrame(
        [(1, k) for k in range(50)] + [(2, 7), (3, 8), (3, 9)], "key BIGINT, id BIGINT"
    )
    met = set()
    groups = {}
    for r in blocks.block_pairs(df, "key", "id", 10).collect():
        groups.setdefault((r.key, r.part_a, r.part_b), []).append(r.id)
    for (key, _, _), ids in groups.items():
        met |= {(key, a, b) for a in ids for b in ids if a < b}
        assert len(ids) <= 40
    assert {(1, a, b) for a in range(50) for b in range(a + 1, 50)} | {(3, 8, 9)} == met


# --- vectors --------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [1024, 8])
def test_vector_links_match_all_pairs(llm, block):
    random = np.random.default_rng(2)
    centres = random.standard_normal((6, 16))
    data = [c + random.standard_normal(16) * 0.06 for c in centres for _ in range(15)]
    data += [data[0], data[0] * 7.5, *random.standard_normal((40, 16))]
    given = [(k, [float(x) for x in v]) for k, v in enumerate(data)]
    bad = [None, [], [0.0] * 16, [math.nan] * 16, [math.inf] + [1.0] * 15, [None] + [1.0] * 15]
    given += [(1000 + k, v) for k, v in enumerate(bad)]
    given += [(2000, [1.0, 0.0]), (2001, [2.0, 0.0])]
    df = llm.createDataFrame(given, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = {r.vec_id: r for r in vectors.near_vectors(df, block_rows=block).collect()}
    unit = np.array(data)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    tied = brute.components(list(range(len(data))), lambda a, b: near[a, b])
    for k in range(len(data)):
        assert (got[k].n_links, got[k].component_id) == (near[k].sum(), tied[k])
        assert got[k].kept == (tied[k] == k)
    for k in range(len(bad)):
        assert (got[1000 + k].n_links, got[1000 + k].component_id) == (0, 1000 + k)
    assert got[2001].component_id == 2000
    assert len(got) == len(given)


def test_vectors_without_rows_and_with_repeats(llm):
    df = llm.createDataFrame(
        [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])],
        "vec_id BIGINT, embedding ARRAY<FLOAT>",
    )
    assert rows(vectors.near_vectors(df)) == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, False)]
    assert rows(vectors.near_vectors(df.where("false"))) == []


# --- tokenizers -----------------------------------------------------------------------------


def test_pieces_match_the_library(odd, none):
    got = pieces.encode_documents(odd, PIECES).select(
        "doc_id",
        F.size("ids"),
        F.sha2(F.array_join("ids", ","), 256),
        F.sha2("decoded", 256),
    )
    assert rows(got) == expected(brute.piece_ids(ODD, PIECES))
    assert rows(pieces.encode_documents(none, PIECES)) == []


def test_pieces_on_random_strings():
    import sentencepiece

    with open(PIECES, "rb") as file:
        model = file.read()
    mine, lib = pieces.encoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    random = np.random.default_rng(3)
    parts = [p for p, ok in zip(mine.texts, mine.alone, strict=True) if ok]
    texts = ["".join(random.choice(parts, random.integers(1, 12))) for _ in range(400)]
    texts += ["".join(random.choice(list("ab ▁\né日🙂"), 20)) for _ in range(200)]
    coded = [np.frombuffer(mine.encode(t), "<i4") for t in texts]
    assert [list(c) for c in coded] == lib.encode(texts)
    ids = random.integers(0, 32000, 900)
    ids[::2] = random.integers(0, 259, 450)
    decoded = mine.decode(ids, np.arange(0, 901, 9)).to_pylist()
    assert decoded == lib.decode(ids.reshape(-1, 9).tolist())


def test_frames_round_trip(llm, odd, none):
    got = frames.encoded_and_read(odd, WORDS).select("doc_id", "n_tokens", F.crc32("ids"))
    plain = [(d, n, c) for d, t in ODD for _, _, n, c in brute.token_ids([(0, t)], WORDS)]
    assert rows(got) == expected(plain)
    starts = sorted((r.start, r.n_tokens) for r in frames.encoded_and_read(odd, WORDS).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    assert rows(frames.encoded_and_read(none, WORDS)) == []


def test_frames_are_independent_and_checked(llm, tmp_path):
    import zstandard

    docs = llm.createDataFrame([(k, SENTENCE * (k % 7)) for k in range(200)], "doc_id INT, text STRING")
    (file, *_) = frames.write_files(docs.coalesce(1), WORDS, scratch_path(llm, "frames"))
    reader = frames.FrameReader(file[0])
    chosen = {d: data for _, d, data in reader.documents({3, 150})}
    every = {d: data for _, d, data in reader.documents()}
    assert chosen == {d: every[d] for d in (3, 150) if d in every}
    path = file[0].removeprefix("file://")
    with open(path, "rb") as f:
        raw = f.read()
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole.startswith(b"".join(every.values()))
    broken = tmp_path / "broken.zst"
    broken.write_bytes(raw[:10] + bytes([raw[10] ^ 1]) + raw[11:])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(frames.FrameReader(str(broken)).documents())


def test_word_pieces_on_random_strings():
    import pyarrow as pa
    from tokenizers import Tokenizer

    with open(WORDS, encoding="utf-8") as file:
        mine = frames.WordEncoder(file.read())
    lib = Tokenizer.from_file(WORDS)
    random = np.random.default_rng(4)
    symbols = [*"aB cé.É,!?;:'s1<|>×÷ß \n日🙂İΣσ", "<|endoftext|>", "<|ENDOFTEXT|>", "Å", "'S."]
    texts = ["".join(random.choice(symbols, random.integers(0, 40))) for _ in range(1500)]
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        ids, begin = mine.encode(pa.array(part))
        for k, text in enumerate(part):
            plain = lib.encode(text, add_special_tokens=False).ids
            assert ids[begin[k] : begin[k + 1]].tolist() == plain


# --- shards ---------------------------------------------------------------------------------


def test_differencing_balances_and_places_every_sum():
    random = np.random.default_rng(6)
    sizes = random.integers(1, 10_000, 400).tolist()
    places = shards.difference([[n, 0, 0, 0] for n in sizes])
    sums = np.bincount([p[0] for p in places], sizes, 4)
    assert sums.max() - sums.min() <= 4
    assert shards.difference([]) == []
    assert sorted(shards.difference([[5, 4, 3]])[0]) == [0, 1, 2]


@pytest.mark.parametrize("run_groups", [1 << 16, 4])
def test_shards(llm, odd, none, run_groups):
    got = shards.shard_by_bytes(odd, run_groups=run_groups).collect()
    plain = [
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in ODD
    ]
    assert expected((r.doc_id, r.size, r.text_crc32) for r in got) == expected(plain)
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in got if r.size == len(SENTENCE) + 1}) == 1
    assert all(0 <= r.shard < 8 for r in got)
    assert rows(shards.shard_by_bytes(none)) == []
    many = llm.range(3000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('x', int(pmod(id * 7919, 997)))").alias("text")
    )
    sums = many.transform(shards.shard_by_bytes).groupBy("shard").agg(F.sum("size").alias("n"))
    totals = [r.n for r in sums.collect()]
    assert len(totals) == 8 and max(totals) - min(totals) <= 2000


# --- models ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def corpus(llm):
    random = np.random.default_rng(8)
    made = {}
    for lang, letters in (("xx", "aeioubcdf"), ("yy", "öülmnprst")):
        made[lang] = ["".join(random.choice(list(letters), random.integers(2, 7))) for _ in range(150)]
    out = []
    for k in range(240):
        lang = "xx" if k % 2 else "yy"
        words = random.choice(made[lang], random.integers(30, 80))
        good = k % 5 != 0
        text = " ".join(words) if good else " ".join(w.upper() + "###" for w in words)
        out.append((k, text, lang, int(good)))
    return llm.createDataFrame(out, "doc_id BIGINT, text STRING, lang STRING, quality INT")


def test_class_model_counts_and_beats_the_base(corpus, odd, none):
    train, held = corpus.where("doc_id % 4 > 0"), corpus.where("doc_id % 4 = 0")
    model = brown.fit(train, classes=8, sweeps=3, dictionary_size=100)
    counts, docs = Counter(), train.collect()
    for r in docs:
        counts.update(brute.white_words(r.text))
    tokens, types = sum(counts.values()) + len(docs), len(counts) + 1

    def plain(doc_id, text):
        words = brute.white_words(text)
        size = tokens + 0.5 * (types + 1)
        base = [math.log10((counts[w] + 0.5) / size) for w in words]
        base.append(math.log10((len(docs) + 0.5) / size))
        return len(words) + 1, 1 + sum(counts[w] > 0 for w in words), sum(base)

    for data in (held, odd):
        given = sorted(map(tuple, data.select("doc_id", "text").collect()), key=repr)
        got = brown.score(data, model).collect()
        assert len(got) == len(given)
        mine = sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got)
        wanted = []
        for d, t in given:
            n, known, base = plain(d, t)
            wanted.append((d or -1, n, known, round(base, 6)))
        assert mine == sorted(wanted)
        assert all(r.train_tokens == tokens and math.isfinite(r.score) for r in got)
    scores = brown.score(held, model).agg(F.sum("score"), F.sum("base_score")).first()
    assert scores[0] > scores[1]
    assert rows(brown.score(none, model)) == []
    empty = brown.score(odd, brown.fit(none)).collect()
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in empty)


def test_class_model_is_a_distribution(corpus):
    model = brown.fit(corpus, classes=8, sweeps=2)
    assert np.allclose((10**model.transitions).sum(axis=1), 1)
    of_class = np.bincount(model.classes, 10**model.emissions, 8)
    assert np.allclose(of_class[np.unique(model.classes)], 1)
    assert (model.classes[1:] > 0).all() and model.classes[brown.END] == 0


def test_exchange_separates_two_kinds_of_units():
    # units 0-9 follow each other, as do 10-19
    classes = 1 + np.random.default_rng(0).integers(0, 2, 20)
    pairs = np.zeros((20, 20))
    pairs[:10, :10] = pairs[10:, 10:] = 5
    for _ in range(6):
        one = np.eye(3)[classes]
        table = one.T @ pairs @ one
        classes = brown.exchange(table, classes, pairs @ one, pairs.T @ one)
    assert len(set(classes[:10])) == len(set(classes[10:])) == 1
    assert classes[0] != classes[10]


def test_languages(llm, corpus, odd, none):
    model = languages.learn(corpus.where("doc_id % 3 > 0"))
    assert model[0] == ["xx", "yy"]
    held = corpus.where("doc_id % 3 = 0").withColumn("score", F.lit(None))
    got = languages.identify(held, model, keep=("lang",)).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    texts = {r.lang: r.text for r in corpus.where("quality = 1").collect()}
    both = llm.createDataFrame([(1, texts["xx"] + " " + texts["yy"])], "doc_id INT, text STRING")
    assert sorted(languages.identify(both, model).first().languages) == ["xx", "yy"]
    strange = {(r.doc_id, r.lang_pred, r.score) for r in languages.identify(odd, model).collect()}
    for d in (3, 4, 5, 6):
        assert (d, "und", 0.0) in strange
    assert languages.identify(odd, model).count() == len(ODD)
    assert rows(languages.identify(none, model)) == []
    unknown = languages.identify(odd, languages.learn(none.withColumn("lang", F.lit(None))))
    assert {r.lang_pred for r in unknown.collect()} == {"und"}


def test_em_recovers_proportions():
    log = np.log(np.array([[0.9, 0.1], [0.1, 0.9]]))
    n = np.array([72.0, 28.0, 10.0, 90.0])
    share, _ = languages.proportions(
        np.exp(log[[0, 1, 0, 1]]), n, np.array([0, 2]), np.full((2, 2), 0.5)
    )
    assert share[0, 0] == pytest.approx(0.775, abs=0.02)
    assert share[1, 1] > 0.98


def test_quality(corpus, odd, none):
    labels = corpus.where("doc_id % 3 > 0").select("doc_id", "quality")
    model = quality.fit(corpus.drop("quality"), labels)
    held = corpus.where("doc_id % 3 = 0")
    got = quality.score_documents(held, model, keep=("quality",)).collect()
    assert all((r.score >= 0.3) == (r.quality == 1) for r in got)
    strange = quality.score_documents(odd, model).collect()
    assert len(strange) == len(ODD)
    assert all(0 <= r.score <= 1 for r in strange)
    prior = {r.score for r in strange if r.doc_id in (3, 4)}
    assert prior == {model.prior}
    assert rows(quality.score_documents(none, model)) == []
    empty = quality.fit(corpus, labels.where("false"))
    assert {r.score for r in quality.score_documents(odd, empty).collect()} == {0.5}


def test_licences(llm, corpus, none):
    model = licenses.fit(corpus)
    wanted = {
        1: ("Licensed under the Apache License, Version 1.1.", ["apache"]),
        2: ("words\nReleased under the MIT License.\nmore words", ["mit"]),
        3: ("This work is licensed under the GNU General Public License, version 2.", ["gpl"]),
        4: ("Licensed under CC BY-NC 3.0.\n\nReleased under the MIT License.", ["cc-by-nc", "mit"]),
        5: ("He lost his driving license last summer.", []),
        6: ("aeio ubcd", []),
        7: (None, []),
        8: ("", []),
        9: ("x " * 50_000 + "\nReleased under the MIT License.", ["mit"]),
    }
    df = llm.createDataFrame(
        [(k, t, "z") for k, (t, _) in wanted.items()] + [(None, None, "z")],
        "doc_id BIGINT, text STRING, line STRING",
    )
    got = licenses.licences(df, model).collect()
    assert len(got) == 10
    assert {r.doc_id: r.families for r in got} == {k: f for k, (_, f) in wanted.items()} | {None: []}
    found = licenses.find_notices(df, model).collect()
    assert all(0.5 <= r.probability <= 1 for r in found)
    assert {(r.doc_id, r.line) for r in found} == {(1, 0), (2, 1), (3, 0), (4, 0), (4, 1), (9, 1)}
    plan = licenses.find_notices(df, model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert rows(licenses.licences(none.withColumn("line", F.lit(1)), model)) == []


def each_template(llm, made):
    """A document for each template, and the families wanted."""
    every = [(f, t) for f in sorted(licenses.TEMPLATES) for t in licenses.TEMPLATES[f]]
    df = llm.createDataFrame(
        [(k, made(t)) for k, (_, t) in enumerate(every)], "doc_id BIGINT, text STRING"
    )
    return df, {k: [f] for k, (f, _) in enumerate(every)}


@pytest.fixture(scope="module")
def licence_model(corpus):
    return licenses.fit(corpus)


def test_every_template_is_a_notice(llm, licence_model):
    df, wanted = each_template(llm, lambda t: t)
    assert {r.doc_id: r.families for r in licenses.licences(df, licence_model).collect()} == wanted


def test_anchors_lose_no_text(licence_model):
    for family in licence_model.templates.values():
        for parts in family:
            chosen = licenses.anchors(parts, licence_model.common, 0.5)
            left = [p for p in parts if not set(p.split(" ")) & set(chosen)]
            assert 2 * len(left) < len(parts)


@pytest.mark.parametrize("n", [20, 500, 2000])
def test_notices_in_long_paragraphs(llm, licence_model, n):
    plain = (SENTENCE + " ") * (n // 16)
    df, wanted = each_template(llm, lambda t: plain + t + " " + plain)
    assert {r.doc_id: r.families for r in licenses.licences(df, licence_model).collect()} == wanted


def test_several_notices_in_a_line(llm, licence_model):
    line = "Licensed under CC BY 4.0. " + SENTENCE + ". Released under the MIT License. "
    df = llm.createDataFrame([(1, line + line), (2, SENTENCE * 50)], "doc_id BIGINT, text STRING")
    got = {r.doc_id: (r.families, r.n_notices) for r in licenses.licences(df, licence_model).collect()}
    assert got == {1: (["cc-by", "mit"], 4), 2: ([], 0)}
    words = sorted(r.word for r in licenses.find_notices(df, licence_model).collect())
    assert words == [1, 21, 26, 46]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "REM "])
def test_wrapped_notices(llm, licence_model, mark):
    def wrapped(template):
        body = [mark + x for x in textwrap.wrap("aeio ubcd " + template, 72 - len(mark))]
        return "\r\n".join(["xx", "", *body, mark.rstrip(), "yy"])

    df, wanted = each_template(llm, wrapped)
    assert {r.doc_id: r.families for r in licenses.licences(df, licence_model).collect()} == wanted


def test_lines_of_notices(llm, licence_model):
    text = "one\n\n\ntwo\n# Released under\n# the MIT License.\n#\n# Licensed under CC BY 4.0.\nthree"
    df = llm.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")
    got = licenses.find_notices(df, licence_model).collect()
    assert sorted((r.line, r.family, r.word) for r in got) == [(2, "mit", 2), (5, "cc-by", 1)]
    assert {r.paragraph for r in got} == {
        "two\n# Released under\n# the MIT License.",
        "# Licensed under CC BY 4.0.\nthree",
    }


def test_texts_in_many_languages(llm):
    letters = ["abcde", "fghij", "klmno", "pqrst", "uvwxy", "zäöüß"]
    random = np.random.default_rng(5)

    def text(of):
        return " ".join("".join(random.choice(list(of), 5)) for _ in range(80))

    df = llm.createDataFrame(
        [(f"l{k}", text(x)) for k, x in enumerate(letters) for _ in range(5)], "lang STRING, text STRING"
    )
    model = languages.learn(df)
    mixed = llm.createDataFrame(
        [(k, " ".join(text(x) for x in letters[:k])) for k in range(1, 7)], "doc_id INT, text STRING"
    )
    for r in languages.identify(mixed, model).collect():
        assert sorted(r.languages) == model[0][: r.doc_id]
        assert sum(r.proportions) == pytest.approx(1)
    for r in languages.identify(mixed, model, set_size=3).collect():
        assert len(r.languages) <= 3


def made_text(random, letters, words=80):
    return " ".join("".join(random.choice(list(letters), 5)) for _ in range(words))


def test_texts_in_no_learned_language_miss_its_bound(llm):
    random = np.random.default_rng(15)
    kinds = {"aa": "abcdef", "bb": "ghijkl", "cc": "äöümno"}
    learned = [(k, made_text(random, v)) for k, v in kinds.items() for _ in range(60)]
    learned += [("cc", None), (None, "abc")]
    model = languages.learn(llm.createDataFrame(learned, "lang STRING, text STRING"))
    held = [(k, made_text(random, kinds[k])) for k in ("aa", "bb") for _ in range(15)]
    held += [("zz", "not learned"), (None, "abc"), ("aa", None), ("bb", "...")]
    least = languages.least_fits(llm.createDataFrame(held, "lang STRING, text STRING"), model)
    assert sorted(least) == ["aa", "bb", "cc"]
    assert languages.CHANCE < least["cc"] < 0  # the mean of all, as none was held out
    good = {
        1: made_text(random, kinds["aa"]),
        2: made_text(random, kinds["aa"], 30) + " " + made_text(random, kinds["bb"], 30),
        3: made_text(random, kinds["cc"], 1),
        4: made_text(random, kinds["bb"], 40) + " " + made_text(random, "qrstuvwxyz", 8),
        5: made_text(random, kinds["aa"], 20_000),
    }
    bad = {
        11: made_text(random, "pqrstuv"),
        12: made_text(random, "abcdefghijklmnopqrstuvwxyz"),
        13: made_text(random, "жзийлпфцчш"),
        14: made_text(random, kinds["aa"], 2) + " " + made_text(random, "wxyzpq", 60),
        15: None,
        16: "",
        17: "123 ...",
    }
    docs = llm.createDataFrame(list((good | bad).items()), "doc_id INT, text STRING")
    found = languages.identify(docs, model, fit=True)
    inside = languages.in_a_learned_language(least)
    assert {r.doc_id for r in found.where(inside).collect()} == set(good)
    assert {r.doc_id for r in found.where("fit is null").collect()} == {15, 16, 17}
    assert found.where(languages.in_a_learned_language({})).count() == 0
    # without held-out texts the bound is chance
    nothing = llm.createDataFrame([], "lang STRING, text STRING")
    assert set(languages.least_fits(nothing, model).values()) == {languages.CHANCE}


def test_columns_to_keep_may_not_clash(llm, odd, corpus):
    benchmark = llm.createDataFrame(BENCHMARK, "item_id BIGINT, text STRING")
    model = languages.learn(corpus)
    voted = quality.fit(corpus.drop("quality"), corpus.select("doc_id", "quality"))
    for run in (
        lambda: languages.identify(odd, model, keep=("score",)),
        lambda: languages.identify(odd, model, keep=("_BODY",)),
        lambda: quality.score_documents(odd, voted, keep=("Score",)),
        lambda: quality.score_documents(odd, voted, keep=("number", "number")),
        lambda: decontaminate.find_benchmark(odd.withColumn("items", F.lit(1)), benchmark, keep=("items",)),
    ):
        with pytest.raises(ValueError, match="clash"):
            run()


def test_votes_match_a_plain_count(llm, corpus):
    """The score of a vector is the weighted vote of its nearest labelled ones, whatever the block."""
    labels = corpus.select("doc_id", "quality")
    model = quality.fit(corpus.drop("quality"), labels)
    texts = [r.text for r in corpus.orderBy("doc_id").limit(40).collect()]
    got = quality.score_documents(
        llm.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING"), model
    ).orderBy("doc_id")
    wanted = brute.votes(model, texts)
    assert [r.score for r in got.collect()] == pytest.approx(wanted, abs=1e-5)


def test_quality_sample_is_of_labels_with_texts(llm, corpus):
    labels = corpus.select("doc_id", "quality")
    strange = llm.range(10_000, 12_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    empty = strange.select("doc_id", F.lit(None).cast("string").alias("text"))
    documents = corpus.select("doc_id", "text").unionByName(empty.limit(1000))
    alone = quality.fit(documents, labels, sample_rows=20)
    more = quality.fit(documents, labels.unionByName(strange, True), sample_rows=20)
    assert len(alone.labels) == 20 and alone.labels.tolist() == more.labels.tolist()
    often = documents.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5)))).drop("copy")
    assert len(quality.fit(often, labels, sample_rows=20).labels) == 20
