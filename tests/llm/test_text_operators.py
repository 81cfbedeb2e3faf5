"""Operators on documents against brute force, and on odd rows."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from starloom import session
from starloom.llm import jaccard, language, mixing, packing, quality, token_counts, token_files, toxicity
from starloom.llm.texts import Hasher, Texts, runs, slices
from starloom.llm.tokenizing import PieceEncoder, TokenizerFile

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id string"

LONG = " ".join(f"word{i % 700} tail{i}" for i in range(20_000))
ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "one two",
    "Ünï cödé — 日本語 🙂",
    "x" * 30_000,
    LONG,
    "a  b \n\n c",
    "<|endoftext|> it's <|endoftext|>",
    "\x1c odd \x85 blanks \xa0",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    rows = [(i, text, "en" if i % 2 else None, "s" if i % 3 else None, None, 0.5, "x") for i, text in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, "no id at all here", None, None, None, None, None), (3, "same id", "en", "s", 1, 1.0, "y")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


def tokenizer(name):
    return TokenizerFile.read(public_tokenizers.path(name))


def library(name):
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(name))


# Shared text helpers.


def test_runs_stop_at_rows_and_hash_alike():
    texts = Texts(pa.array(["ab cd", None, "", "cd", "e"]))
    starts, ends = runs(texts, texts.data != 32)
    words = [bytes(texts.data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    assert words == ["ab", "cd", "cd", "e"]
    assert texts.rows_of(starts).tolist() == [0, 0, 3, 4]
    hashes = Hasher(texts.data).spans(starts, ends)
    assert hashes[1] == hashes[2]
    assert len(set(hashes.tolist())) == 3


def test_slices_hold_whole_rows():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * 10, "b" * 50, None, "c"])})
    parts = list(slices(iter([batch]), "text", 20))
    assert [p.num_rows for p in parts] == [1, 1, 2]
    assert list(slices(iter([batch.slice(0, 0)]), "text", 20)) == []


# Language.


def test_languages_are_told_apart(documents):
    rows = documents.select("doc_id", "lang").join(language.language_report(documents), "doc_id").collect()
    learned = {r["lang"] for r in rows}
    assert {r["lang_pred"] for r in rows} <= learned | {"und"}
    unseen = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in unseen) >= 0.9 * len(unseen)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_phrases_match_a_plain_parse():
    sample = b"the cat sat on the mat and the rat ate the cat"
    parser = language.Parser.compile(sample)
    for text in (b"the cat and the dog", b"zzz", b"q the mat", b"t"):
        folded = language._FOLD[np.frombuffer(text, np.uint8)].tobytes()
        at = count = 0
        while at < len(folded):
            size = 1
            while at + size < len(folded) and folded[at : at + size + 1] in language._FOLD[np.frombuffer(sample, np.uint8)].tobytes():
                size += 1
            at, count = at + size, count + 1
        lanes = np.zeros((1, language.SEGMENT), np.uint8)
        lanes[0, : len(text)] = np.frombuffer(text, np.uint8)
        assert parser.phrases(lanes, np.array([len(text)]))[0] == count


def test_language_of_odd_rows(odd, empty):
    found = Counter((r["doc_id"], r["lang_pred"], r["score"] > 0) for r in language.language_report(odd).collect())
    assert sum(found.values()) == odd.count()
    assert (0, "und", False) in found and (2, "und", False) in found
    assert language.language_report(empty).count() == 0
    nothing = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.language_report(nothing).collect()} == {"und"}
    kept = language.with_known_language(odd)
    assert kept.columns == odd.columns
    assert kept.where("text is null or trim(text) = ''").count() == 0


# Toxicity.


def _toxic_corpus(spark, count=600):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(count):
        text = list(rng.choice(words, size=40))
        bad = i % 5 == 0
        if bad:
            for k, insult in enumerate(rng.choice(["scoundrel", "twit", "nitwitted", "nitwitting", "nitwitish", "nitwitude"], size=3)):
                text[7 * k] = insult
        rows.append((i, " ".join(text), int(bad)))
    documents = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return documents, labels, {i: y for i, _, y in rows}


def test_toxic_documents_are_found(spark):
    documents, labels, truth = _toxic_corpus(spark)
    rows = toxicity.toxicity_report(documents, labels).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    kept = toxicity.without_toxic(documents, labels)
    assert kept.columns == documents.columns
    assert kept.count() == sum(r["score"] < 0.5 for r in rows)


def test_toxicity_of_odd_rows(spark, odd, empty, labels):
    found = toxicity.toxicity_report(odd, labels).collect()
    assert len(found) == odd.count()
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in found)
    none = labels.where("false")
    assert {r["predicted"] for r in toxicity.toxicity_report(odd, none).collect()} == {0}
    assert toxicity.toxicity_report(empty, labels).count() == 0
    with_nulls = labels.unionByName(spark.createDataFrame([(None, 1, 1), (1, None, None)], labels.schema))
    assert toxicity.toxicity_report(odd, with_nulls).count() == odd.count()


def test_few_labels_make_a_classifier(documents, labels):
    """Ten toxic examples: every labelled document with a word of three toxic and no clean one."""
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    words = {i: set(re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())) for i, t in texts.items()}
    learned = [i for i in truth if i in words and zlib.crc32(str(i).encode()) % 5]
    toxic, clean = (Counter(w for i in learned if truth[i] == y for w in words[i]) for y in (1, 0))
    marked = {w for w, n in toxic.items() if n >= 3 and not clean[w]}
    sure = {i for i in words if truth.get(i) and words[i] & marked}
    rows = toxicity.toxicity_report(documents, labels).collect()
    found = {r["doc_id"] for r in rows if r["predicted"]}
    assert sure and sure <= found
    assert not any(truth.get(i) == 0 for i in found)
    kept = {r["doc_id"] for r in toxicity.without_toxic(documents, labels).collect()}
    assert kept == set(texts) - found


@pytest.mark.parametrize("bad", [1, 3, 20])
def test_both_classes_always_make_a_classifier(bad):
    texts = [f"the usual words of number {i}" for i in range(40)] + [f"the scoundrel of case x{i}" for i in range(bad)]
    model = toxicity.train(pa.array(texts), np.arange(len(texts)) >= 40)
    plain, rude = model.scores(Texts(pa.array(["the usual words of another", "the scoundrel of case x0"])))
    assert 0 < plain < 0.5 and rude > plain
    # Copies of a clean text do not take the class away.
    same = toxicity.train(pa.array([*texts[:40], texts[0]]), np.arange(41) == 40)
    assert np.isfinite(same.intercept)


def test_label_model_discounts_repeated_votes():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    sure = np.where(rng.random(4000) < 0.9, truth, ~truth)
    weak = np.where(rng.random(4000) < 0.6, truth, ~truth)
    columns = [sure, np.where(rng.random(4000) < 0.9, truth, ~truth), np.where(rng.random(4000) < 0.85, truth, ~truth), weak, weak, weak]
    votes = np.stack([np.where(c, 1, -1) for c in columns], axis=1).astype(np.int8)
    posterior, table, weight = toxicity.label_model(votes, 0.3)
    assert ((posterior > 0.5) == truth).mean() > 0.93
    assert weight[3] < 0.5 < weight[0]
    says_toxic = np.exp(table[:, :, 2])  # by class and voter
    told_apart = (says_toxic[1] - says_toxic[0]) * weight
    assert told_apart[0] > 2 * told_apart[3]


# Jaccard join.


def _shingles(text, size):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[k:] for k in range(size)), strict=False))


def _components(rows, size, percent):
    sets = [_shingles(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    smallest = {}
    for k, (doc_id, _) in enumerate(rows):
        r = find(k)
        if doc_id is not None:
            smallest[r] = min(smallest.get(r, doc_id), doc_id)
    return [(doc_id, len(sets[k]), smallest.get(find(k))) for k, (doc_id, _) in enumerate(rows)]


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components(spark, words, percent):
    """Exact copies, families of near copies around the threshold, and shared passages."""
    rng = np.random.default_rng(words)
    vocabulary = [f"v{i}" for i in range(400)]
    rows = []
    for _ in range(25):
        base = list(rng.choice(vocabulary, size=rng.integers(1, 130)))
        for _ in range(rng.integers(1, 9)):
            copy = list(base)
            for _ in range(rng.integers(0, 4)):
                copy[rng.integers(len(copy))] = str(rng.choice(vocabulary))
            rows.append(" ".join(copy).upper() if rng.random() < 0.1 else " ".join(copy))
    passage = " ".join(rng.choice(vocabulary, size=60))
    rows += [passage + " " + " ".join(rng.choice(vocabulary, size=5)) for _ in range(20)]
    rows = list(enumerate(rows))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted(tuple(r) for r in jaccard.joined(frame, words, percent).collect())
    assert found == sorted(_components(rows, words, percent))


def test_jaccard_of_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect() if r["doc_id"] is not None]
    found = [tuple(r) for r in jaccard.joined(odd, 3, 90).collect()]
    assert Counter(f for f in found if f[0] is not None) == Counter(_components(rows, 3, 90))
    assert [f for f in found if f[0] is None] == [(None, 3, None)]
    assert jaccard.joined(empty, 3, 90).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        [(False, i) for i in range(len(ODD_TEXTS))] + [(False, 3), (True, 0)]
    )
    assert jaccard.one_of_each(empty).count() == 0


def test_one_document_of_each_group_stays(documents):
    twice = documents.unionByName(documents.withColumn("doc_id", F.col("doc_id") + 1_000_000))
    kept = jaccard.one_of_each(twice)
    assert kept.where("doc_id >= 1000000").count() == 0


# Mixing.


def test_mixture_meets_its_targets(documents):
    rows = mixing.mixed(documents).collect()
    sizes = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in documents.collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == sizes
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    taken, target = Counter(), {}
    for r in rows:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - t) < 1 for s, t in target.items())
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    again = mixing.mixed(documents.repartition(7), block_words=64).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_every_stretch_of_the_schedule_is_mixed(spark):
    rows = [(f"s{k}", k, 1_000_000, float(t), t) for k, t in enumerate((500_000, 300_000, 150_000, 50_000))]
    targets = spark.createDataFrame(rows, "source string, source_no long, source_size long, target double, take long")
    slots = [r["source_no"] for r in mixing.schedule(targets, 1000).orderBy("slot").collect()]
    for cut in (100, 250, 500, 1000):
        shares = [slots[:cut].count(k) / cut for k in range(4)]
        assert shares == pytest.approx([0.5, 0.3, 0.15, 0.05], abs=4 / cut)


def test_mixture_of_odd_rows(odd, empty):
    rows = mixing.mixed(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mixed(empty).count() == 0
    assert mixing.mixed(odd.where("text is null")).count() == 1
    out = mixing.repeated(odd)
    assert out.columns == odd.columns
    assert out.count() > 0


@pytest.mark.parametrize("doc_id", [lambda k: None, lambda k: k % 3, lambda k: k])
def test_copies_are_counted_per_row(spark, doc_id):
    """Documents that share an id, or have none, meet the targets of their own sources."""
    sources = {"a": 20, "b": 400, "c": 400}
    rows = [(doc_id(k), f"{s} {k} " + " ".join(["w"] * (5 + k % 4)), s) for s, n in sources.items() for k in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = mixing.repeated(frame).collect()
    words, copies = Counter(), Counter((r["source"], r["text"]) for r in out)
    for r in out:
        words[r["source"]] += len(r["text"].split())
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in sources}
    left = sum(sizes.values()) - 3 * sizes["a"]  # source a stops at its cap
    assert words["a"] == 3 * sizes["a"]
    assert words["b"] == pytest.approx(left * 2 / 3, abs=5)
    assert words["c"] == pytest.approx(left / 3, abs=5)
    for source, n in sources.items():
        seen = [copies[source, t] for _, t, x in rows if x == source]
        assert len(seen) == n and max(seen) - min(seen) <= 1


def test_capped_targets(spark):
    text = lambda n: " ".join(["w"] * n)
    rows = [(1, text(10), "a"), (2, text(200), "b"), (3, text(400), "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = {r["doc_id"]: r["target"] for r in mixing.mixed(frame).collect()}
    # Weights 5, 2, 1: the first stops at 30, the second would get 580 / 3 * 2.
    assert target == {1: 30.0, 2: pytest.approx(580 / 3 * 2), 3: pytest.approx(580 / 3)}


# Packing.


def _check_packing(pieces, ids, capacity):
    for doc, rows in pieces.groupby("doc_id", dropna=False):
        rows = rows.sort_values("start")
        own = ids[doc]
        assert rows["length"].sum() == len(own)
        at = 0
        for r in rows.itertuples():
            assert r.start == at and r.doc_tokens == len(own)
            assert zlib.crc32(own[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
    for _, rows in pieces.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows["length"].sum() <= capacity
        assert rows["offset"].tolist() == (rows["length"].cumsum() - rows["length"]).tolist()


def test_packing(documents):
    model = library("word_bpe_49k.json")
    ids = {
        r["doc_id"]: np.array([*model.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        for r in documents.collect()
    }
    pieces = packing.packed(documents, tokenizer("word_bpe_49k.json")).toPandas()
    _check_packing(pieces, ids, packing.CAPACITY)
    used = pieces["length"].sum()
    assert pieces["sequence_id"].nunique() <= 1.05 * used / packing.CAPACITY + 1


def test_sequences_hold_the_ids(documents):
    spark = documents.sparkSession
    pieces = packing.token_pieces(documents.limit(40), tokenizer("word_bpe_49k.json"), with_ids=True).cache()
    rows = packing.sequences(pieces, packing.pack(pieces.drop("ids"))).collect()
    assert all(len(r["ids"]) == packing.CAPACITY for r in rows)
    assert sum(r["used"] for r in rows) == pieces.agg(F.sum("length")).first()[0]
    assert sum(sum(i == 2 for i in r["ids"][: r["used"]]) for r in rows) >= 40
    spark.catalog.clearCache()


def test_packing_of_odd_rows(odd, empty):
    pieces = packing.packed(odd, tokenizer("word_bpe_49k.json")).toPandas()
    assert pieces["start"].eq(0).sum() == odd.count()
    assert pieces.loc[pieces["doc_id"] == 0, "length"].tolist() == [1]
    assert packing.packed(empty, tokenizer("word_bpe_49k.json")).count() == 0


# Token counts and files.


def test_token_counts(documents, odd, empty):
    model = library("byte_bpe_50k.json")
    for frame in (documents, odd):
        rows = frame.select("doc_id", "text").collect()
        expected = Counter(
            (r["doc_id"], len((r["text"] or "").encode()), n, n > 512)
            for r in rows
            for n in [len(model.encode(r["text"] or "", add_special_tokens=False).ids)]
        )
        assert Counter(map(tuple, token_counts.token_report(frame, tokenizer("byte_bpe_50k.json")).collect())) == expected
    assert token_counts.token_report(empty, tokenizer("byte_bpe_50k.json")).count() == 0


def test_token_files(spark, documents, odd, empty, tmp_path):
    model = library("byte_bpe_50k.json")
    for name, frame in (("plain", documents), ("odd", odd)):
        folder = str(tmp_path / name)
        token_files.write(frame.repartition(5), tokenizer("byte_bpe_50k.json"), folder)
        rows = sorted(token_files.read(spark, folder).collect(), key=lambda r: r["start"])
        assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in frame.collect()), key=lambda i: (i is not None, i))
        assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows]])[:-1].tolist()
        ids = Counter(
            (r["doc_id"], zlib.crc32(np.array([*model.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4").tobytes()))
            for r in frame.collect()
        )
        assert Counter((r["doc_id"], r["ids_crc32"]) for r in rows) == ids
        assert token_files.read_ids(spark, folder).where("element_at(ids, -1) != 0").count() == 0
    folder = str(tmp_path / "empty")
    token_files.write(empty, tokenizer("byte_bpe_50k.json"), folder)
    assert token_files.read(spark, folder).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_like_the_library(name):
    model = library(name)
    encoder = PieceEncoder(tokenizer(name).definition)
    texts = [t or "" for t in ODD_TEXTS] + [
        " a", "a ", "a\n b", "a \n b", "<|EndOfText|> x", "x, y. z.\nNext, line", "don't I'll", "  \t", "",
    ]
    for _ in range(2):  # the second time from the cache
        ids, bounds = encoder.encode(pa.array(texts))
        found = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert found == [model.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_of_letters_skip_the_steps_around_the_model(name, monkeypatch):
    encoder, asked = PieceEncoder(tokenizer(name).definition), []
    by_library = encoder._by_library
    monkeypatch.setattr(encoder, "_by_library", lambda pieces: asked.extend(pieces) or by_library(pieces))
    text = "Qwertz, éTÜdes! straße\nÀ. d'été ÷× e\u0301t\u00a0x <|endoftext|> 12ab"
    ids, _ = encoder.encode(pa.array([text]))
    assert ids.tolist() == library(name).encode(text, add_special_tokens=False).ids
    found = {x.strip(" ").lower() for x in asked}
    assert {"d'été", "÷×", "<|endoftext|>", "12ab"} <= found
    assert not {"qwertz", "étüdes", "straße", "à"} & found


def test_the_cache_keeps_what_is_in_use_in_arrays():
    from starloom.llm.tokenizing import _Cache

    asked = []

    def encode(pieces):
        asked.extend(pieces)
        order = list(range(len(pieces)))[::-1]
        ids = [ord(c) for k in order for c in pieces[k]]
        return np.array(order), np.array(ids, np.uint32), np.array([len(pieces[k]) for k in order])

    cache = _Cache(encode, 10)
    for k in range(200):
        pieces = ["used", f"once {k}", "", "x" * 65 if k % 7 else "y" * 3000]
        ids, counts = cache.look_up(pieces)
        assert "".join(map(chr, ids)) == "".join(pieces) and counts.tolist() == [len(x) for x in pieces]
        assert len(cache._rows) <= 20 + 4 and len(cache._ids) < 20_000
    assert asked.count("used") < 30 and asked.count("once 7") == 1


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_are_cut_only_where_the_library_cuts(name):
    model, encoder = library(name), PieceEncoder(tokenizer(name).definition)
    some = ["a", "É", " ", "\n", "\u3000", ",", "!", "'s", "×", "e\u0301", "\u0301", "<|endoftext|>", "\r", "Σ"]
    texts = ["".join(x) for x in itertools.product(some, repeat=3)]
    ids, bounds = encoder.encode(pa.array(texts))
    found = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert found == [model.encode(t, add_special_tokens=False).ids for t in texts]


# Quality.


def _base(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen = 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(k, k + 5))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, lines, len(covered), failed


def test_quality_counts(documents, odd, empty):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for frame in (documents, odd):
        expected = Counter((r["doc_id"], *_base(r["text"])) for r in frame.collect())
        rows = quality.quality_report(frame).collect()
        assert Counter((r["doc_id"], *(r[c] for c in columns)) for r in rows) == expected
        assert not any(r["kept"] and r["base_failed"] for r in rows)
    assert quality.quality_report(empty).count() == 0


def test_bands_reject_repetition_and_noise(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), size=rng.integers(2, 9))) for _ in range(900)]
    prose = " ".join(rng.choice(words, size=700))
    # Repeats beyond the window rule's sight: every word differs by a counter.
    table = " ".join(f"row-{i:05d}-value" for i in range(700))
    letters = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/")
    noise = " ".join("".join(rng.choice(letters, size=60)) for _ in range(300))
    frame = spark.createDataFrame([(1, prose), (2, table), (3, noise)], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in quality.quality_report(frame).collect()} == {1: True, 2: False, 3: False}


def test_clean_documents_are_kept(documents, labels):
    judged = quality.quality_report(documents).where("not base_failed").join(labels, "doc_id")
    assert judged.where("quality = 1 and not kept").count() == 0


def test_bad_documents_beyond_the_good_are_rejected(spark, documents, labels):
    """Against brute force: what compresses better than every good text up to a third longer."""
    import zstandard

    compress = zstandard.ZstdCompressor(level=3).compress
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    rows = quality.quality_report(frame).join(marks, "doc_id").join(frame.select("doc_id", "text"), "doc_id").collect()
    rows = [(len(t), len(t) / len(compress(t)), r) for r in rows if not r["base_failed"] for t in [r["text"].encode()]]
    good = [(n, ratio) for n, ratio, r in rows if r["quality"] == 1]
    beyond = [
        r for n, ratio, r in rows if r["quality"] == 0 and n < 60_000
        and ratio > 1.05 * max((x for m, x in good if n / 1.5 <= m <= 1.5 * n), default=9.0)
    ]
    assert beyond and not any(r["kept"] for r in beyond)
    assert sum(r["kept"] for _, _, r in rows if r["quality"] == 0) <= 110
    assert all(r["kept"] for _, _, r in rows if r["quality"] == 1)
    counts = {r["quality"]: r for r in quality.kept_by_label(quality.quality_report(documents), labels).collect()}
    for mark, row in counts.items():
        assert row["documents"] == row["base_rejected"] + row["bands_rejected"] + row["kept"], mark
    assert counts[1]["bands_rejected"] == 0


def test_short_texts_are_judged_by_chunks(spark):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), size=rng.integers(2, 9))) for _ in range(900)]
    prose = " ".join(rng.choice(words, size=220))
    table = " ".join(f"row-{i:05d}-value" for i in range(40))
    frame = spark.createDataFrame([(1, prose), (2, f"{prose} {table}")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in quality.quality_report(frame).collect()}
    assert rows[1]["kept"] and rows[1]["chunks_outside"] == 0
    assert not rows[2]["kept"] and rows[2]["chunks_outside"] > 0
    assert len(f"{prose} {table}") < 4_096


# Shuffles of the Jaccard join.


def test_posting_lists_are_built_behind_one_shuffle(spark):
    rows = [(1, 40, [5, 6, 7]), (2, 41, [5, 8, 9]), (3, 90, [5, 10, 11]), (4, 40, [12, 13, 14])]
    groups = spark.createDataFrame(rows, "g long, n long, prefix array<long>")
    lists = jaccard._lists(groups, 80)
    assert lists._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    found = [(r["token"], r["g"], r["listed"], r["lead"]["g"]) for r in lists.collect()]
    # Sets 1 and 2 meet under their common shingle; set 3 is too large, set 4 shares none.
    assert {(t, lead) for t, _, _, lead in found} <= {(5, 1), (5, 2)}
    assert {g for _, g, _, _ in found} == {1, 2}


def test_shuffle_files_go_while_the_join_runs_only(spark, documents):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    assert jaccard.joined(documents.limit(30)).count() == 30
    assert spark.conf.get(name) == before
    with session.passing_shuffles(spark):
        assert spark.conf.get(name) == "true"
