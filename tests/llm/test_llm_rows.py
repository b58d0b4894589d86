import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from cases import WORD, awkward_rows, brute_fingerprint, brute_lines, brute_measures, groups, sha
from tokenizers import Tokenizer

import corpus_pipeline
from bucketlens.llm import bpe, language_id, mixing, quality_classifier, quality_rules, queries, sharding
from bucketlens.llm.queries import TOKENIZER

ROWS = awkward_rows()


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Queries with SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, tables, database, name):
    got = queries.QUERIES[name](spark, tables)
    result = database.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    expected = sorted(result.fetchall(), key=repr)
    assert expected and found(got.select(*columns)) == expected


# Quality rules


def test_measures_equal_brute_force(awkward):
    got = quality_rules.quality_rules_query(awkward)
    expected = []
    for row in ROWS:
        m = brute_measures(row[1])
        expected.append((row[0], *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
    assert found(got.drop("kept")) == sorted(expected, key=repr)
    assert not got.where("base_failed AND kept").count()


def test_rules_keep_good_documents_and_drop_most_bad_ones(spark, corpus):
    judged = quality_rules.quality_rules_query(corpus).where("NOT base_failed")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    share = {r[0]: r[1] for r in judged.join(labels, "doc_id").groupBy("quality").agg({"kept": "count", "doc_id": "count"}).collect()}
    kept = {r[0]: r[1] for r in judged.where("kept").join(labels, "doc_id").groupBy("quality").count().collect()}
    assert kept[1] >= 0.97 * share[1] and kept.get(0, 0) <= 0.6 * share[0]


def test_rules_of_an_empty_table_and_own_rules(awkward, nothing):
    assert found(quality_rules.quality_rules_query(nothing)) == []
    rules = (quality_rules.Rule("few_words", "n_words", None, 500),)
    judged = quality_rules.apply_rules(awkward, rules).where("NOT base_failed")
    assert all(r.kept == r.few_words == (r.n_words <= 500) for r in judged.collect())


def test_texts_without_words_fail_no_query(spark, tmp_path):
    good = "The house that stands by the river is old and it was built of stone with a roof of slate for the miller."
    texts = [None, "", " \t\x0b\n \x0c\r\n", "\n\n", good, "one", good.replace(" ", "\n"), "# " * 30]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id INT, text STRING")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op6_quality_rules"](spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = connection.execute(queries.ORACLES["op6_quality_rules"])
    assert found(got.select(*(c[0] for c in result.description))) == sorted(result.fetchall(), key=repr)
    assert [r.doc_id for r in got.orderBy("doc_id").collect() if r.kept] == [4]
    rules = (*quality_rules.RULES, quality_rules.Rule("few_lines", "n_lines / n_words", 0.01, 0.5))
    judged = quality_rules.apply_rules(spark.read.parquet(f"{tmp_path}/documents.parquet"), rules)
    no_words = judged.where("n_words = 0").collect()
    assert len(no_words) == 4
    assert all(r.base_failed and not r.kept and all(r[rule.name] for rule in rules) for r in no_words)


# Sharding


def test_matrix_has_exact_sums():
    blocks = np.array([0, 5, 17, 1, 40])
    matrix = sharding.communication_matrix(blocks, 6, 1)
    assert (matrix.sum(axis=1) == blocks).all()
    assert sorted(matrix.sum(axis=0)) == sorted(sharding.shard_sizes(63, 6))


def test_matrix_beyond_a_billion_rows():
    blocks = np.full(1_000, 2_000_000, dtype=np.int64)
    matrix = sharding.communication_matrix(blocks, 24, 3)
    assert (matrix.sum(axis=1) == blocks).all() and sorted(matrix.sum(axis=0)) == sorted(sharding.shard_sizes(2_000_000_000, 24))
    # Deviations from an even share are of the size that drawing without replacement gives.
    spread = (matrix - 2_000_000 / 24).std()
    assert 0.95 < spread / np.sqrt(2_000_000 / 24 * 23 / 24) < 1.05


@pytest.mark.parametrize("good, bad, taken", [(5, 7, 6), (30, 3, 20), (3, 400, 100), (1, 1, 1), (0, 5, 3), (5, 0, 3), (200, 300, 250)])
def test_hypergeometric_draws(good, bad, taken):
    """Frequencies against the exact probabilities."""
    from math import comb

    draw, n = np.random.Generator(np.random.PCG64(1)), 20_000
    seen = Counter(sharding.hypergeometric(draw, good, bad, taken) for _ in range(n))
    for k in range(taken + 1):
        p = comb(good, k) * comb(bad, taken - k) / comb(good + bad, taken) if taken - k <= bad else 0
        assert abs(seen[k] - n * p) <= 5 * np.sqrt(n * p * (1 - p)) + 4


def test_equal_rows_are_dealt_over_blocks(spark, monkeypatch):
    """A row repeated very often: no window of one task holds all of it."""
    rows = spark.range(0, 30_000, 1, 6).selectExpr("1 AS doc_id", "'same' AS text").unionAll(spark.range(50).selectExpr("CAST(id AS INT)", "'x'"))
    given = rows.selectExpr("doc_id", "text", "'c' AS _deal", "'s' AS shard")
    got = sharding.shuffle_into_shards(given, ["doc_id", "text"], 7, rows_per_block=500)
    sizes = Counter((r.shard) for r in got.collect())
    assert sum(sizes.values()) == 30_050 and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(7):
        assert sorted(r.slot for r in got.where(got.shard == shard).collect()) == list(range(sizes[shard]))
    largest, staged = [], sharding.staged

    def counting(df, name):
        out = staged(df, name)
        if name == "shard-placed":
            largest.append(max(r["count"] for r in out.groupBy("shard", "_part").count().collect()))
        return out

    monkeypatch.setattr(sharding, "staged", counting)
    sharding.shuffle_into_shards(given, ["doc_id", "text"], 7, rows_per_block=500).count()
    assert largest[0] < 1_500


def test_shards_are_exact_gapless_and_uniform(corpus):
    got = sharding.shard_documents(corpus).collect()
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    assert found(sharding.shard_documents(corpus)) == sorted(map(tuple, got), key=repr)
    # Neighbouring ids are spread: 23 degrees of freedom, far below any plausible bound.
    halves = Counter(r.shard for r in got if r.doc_id < 500)
    expected = {s: 500 * n / 1000 for s, n in sizes.items()}
    assert sum((halves[s] - e) ** 2 / e for s, e in expected.items()) < 60


def test_shards_of_awkward_documents(awkward, nothing):
    got = sharding.shard_documents(awkward).collect()
    expected = [(i, 8 + len((t or "").encode()), zlib.crc32((t or "").encode()), "rows") for i, t, *_ in ROWS]
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.law) for r in got), key=repr) == sorted(expected, key=repr)
    assert found(sharding.shard_documents(nothing)) == []
    kept = sharding.shuffle_into_shards(awkward, ["doc_id", "text"], 3)
    assert kept.columns == [c for c in awkward.columns if c != "shard"] + ["shard", "slot"]
    assert kept.count() == len(ROWS)


def test_written_shards(awkward, tmp_path):
    sharded = sharding.shuffle_into_shards(awkward.select("doc_id", "text"), ["doc_id", "text"], 3)
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    again = awkward.sparkSession.read.parquet(str(tmp_path / "shards")).select(*sharded.columns)
    assert found(again) == found(sharded)


# Mixing


def brute_targets(sizes, share=1.5, ceiling=2.0, weights=(5.0, 2.0, 1.0)):
    """Weighted filling by repeated sharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    target, budget, open_ = {}, share * sum(sizes.values()), set(order)
    while open_:
        level = budget / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= ceiling * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: ceiling * sizes[s] for s in full}
        budget -= sum(ceiling * sizes[s] for s in full)
        open_ -= full
    return target


def test_mix_equals_brute_force(awkward, nothing):
    sizes = Counter()
    for _, text, _, source, *_ in ROWS:
        sizes[source] += len(WORD.findall(text or ""))
    targets = brute_targets(dict(sizes))
    got = mixing.mixing_plan(awkward).collect()
    assert len(got) == len(ROWS)
    for r in got:
        rate = targets[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert int(rate) <= r.copies <= min(2, int(rate) + 1)
    assert found(mixing.mix_query(nothing)) == []


def test_mixed_corpus_comes_near_its_targets(corpus):
    plan = mixing.mixing_plan(corpus).collect()
    taken = Counter()
    for r in plan:
        taken[r.source] += r.copies * r.size
    target = {r.source: r.target for r in plan}
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.05)
    assert all(taken[s] == pytest.approx(t, rel=0.35) for s, t in target.items())
    mixed = mixing.mix_documents(corpus)
    assert mixed.columns == corpus.columns
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == +Counter({r.doc_id: r.copies for r in plan})


def test_mix_of_rows_without_ids(spark):
    """Rows without an id are drawn one by one: targets are met as with ids."""
    rows = [(None, f"word{k} " * 10, f"s{k % 3}") for k in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    taken, target = Counter(), {}
    for r in mixing.mixing_plan(docs).collect():
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
    assert all(taken[s] == pytest.approx(t, rel=0.06) for s, t in target.items() if t > 0)
    assert mixing.mix_documents(docs).count() * 10 == sum(taken.values())


def test_sample_of_copies_is_bounded(spark):
    """Equal rows are all selected or none; they count once, and a language has a most."""
    texts = [(k, "the same words again and again", "en") for k in range(500)] + [(None, "das gleiche noch einmal", "de")] * 500
    texts += [(1_000 + k, f"another text number {k} in english words", "en") for k in range(300)] + [(2_000 + k, f"ein anderer text nummer {k}", "de") for k in range(300)]
    learnable = spark.createDataFrame(texts, "doc_id BIGINT, text STRING, lang STRING")
    given, sizes = language_id.ftrl, []

    def counting(vectors, classes, n):
        sizes.append(len(vectors))
        return given(vectors, classes, n)

    language_id.ftrl = counting
    try:
        model = language_id.train(learnable, sample_per_language=40)
    finally:
        language_id.ftrl = given
    assert model["languages"] == ["de", "en"] and sizes[0] <= 2 * 2 * 40


def test_mix_keeps_clashing_columns(awkward):
    assert mixing.mix_documents(awkward).columns == awkward.columns


def test_quality_of_alike_rows(spark):
    """All rows of both classes alike, or of one class: no variance, but a model."""
    docs = spark.createDataFrame([(i, "the same text" if i < 60 else f"text {i} " * (i % 7)) for i in range(90)], "doc_id BIGINT, text STRING")
    for ids in (range(60), range(90)):
        labels = spark.createDataFrame([(i, i % 2 if i < 60 else 1) for i in ids], "doc_id BIGINT, quality INT")
        got = quality_classifier.quality_query(docs, labels).collect()
        assert len(got) == 90 and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id < 60}) == 1


# Language


def test_language_of_held_out_documents(corpus):
    truth = {r.doc_id: r.lang for r in corpus.select("doc_id", "lang").collect()}
    got = language_id.language_query(corpus).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_awkward_documents(awkward, nothing):
    got = {r.doc_id: r for r in language_id.language_query(awkward).collect()}
    texts = {i: t for i, t, *_ in ROWS}
    for i, r in got.items():
        if i is not None:
            assert (r.lang_pred == "und") == (not any(map(str.isalpha, texts[i] or "")))
    assert found(language_id.language_query(nothing)) == []
    unlabelled = language_id.language_query(awkward.withColumn("lang", awkward.lang.substr(9, 1).substr(5, 0)).where("lang IS NULL"))
    assert {r.lang_pred for r in unlabelled.collect()} <= {"und"}
    kept = language_id.keep_identified(awkward)
    assert kept.columns == awkward.columns and not kept.where("text IS NULL").count()


def test_temperature_lowers_the_log_loss():
    draw = np.random.default_rng(0)
    truth = draw.integers(0, 3, 400)
    logits = draw.normal(size=(400, 3)) * 8
    logits[np.arange(400), truth] += 4
    t = language_id.temperature(logits, truth)
    loss = lambda s: -np.log(language_id._softmax(logits / s)[np.arange(400), truth] + 1e-12).mean()
    assert t > 1 and loss(t) < loss(1.0)


# Quality classifier


def test_quality_of_held_out_documents(spark, corpus):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_classifier.score_documents(corpus, labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert {r.doc_id for r in got.where("held_out").collect()} == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good]) >= 0.97


def test_quality_of_awkward_documents(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, None), (7, 1), (8, 3), (None, 1)], "doc_id BIGINT, quality INT")
    for given in (labels, labels.where("quality = 1"), labels.where("false")):
        got = quality_classifier.score_documents(awkward, given).collect()
        assert len(got) == len(ROWS)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert found(quality_classifier.score_documents(nothing, labels)) == []


def test_density_follows_the_definition():
    draw = np.random.default_rng(0)
    width = quality_classifier.WIDTH
    mean = draw.normal(size=(2, width))
    factors, logs, covariances = [], [], []
    for _ in range(2):
        a = draw.normal(size=(width, width)) / 4 + np.eye(width)
        covariances.append(a @ a.T)
        cholesky = np.linalg.cholesky(covariances[-1])
        factors.append(np.linalg.inv(cholesky))
        logs.append(-np.log(np.diag(cholesky)).sum())
    x = draw.normal(size=(20, width)) / 3
    model = {"mean": mean, "factors": factors, "logs": logs, "odds": 0.3}
    density = [
        -0.5 * np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m) - 0.5 * np.linalg.slogdet(c)[1] for m, c in zip(mean, covariances)
    ]
    expected = 1 / (1 + np.exp(-np.clip(density[1] - density[0] + 0.3, -50, 50)))
    assert quality_classifier.scores(model, x) == pytest.approx(expected, abs=1e-5)


# Tokens


@pytest.fixture(scope="module")
def tokens():
    return bpe.load_vocabulary(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_tokens_equal_the_library(spark, awkward, nothing, corpus, library):
    given = awkward.select("doc_id", "text").union(corpus.where("doc_id < 100").select("doc_id", "text"))
    expected = [(r.doc_id, *digests(library, r.text)) for r in given.collect()]
    assert found(bpe.bpe_query(given, TOKENIZER)) == sorted(expected, key=repr)
    assert found(bpe.bpe_query(nothing, TOKENIZER)) == []


def test_ids_round_trip(awkward):
    encoded = bpe.encode_documents(awkward, TOKENIZER)
    expected = sorted(((i, t or "") for i, t, *_ in ROWS), key=repr)
    assert found(bpe.decode_documents(encoded, TOKENIZER)) == expected


def test_random_texts_equal_the_library(tokens, library):
    draw = random.Random(8)
    signs = "aabbcc  \n\t\r\x0b\x1c\x85\xa0 　''srtvemld0123٣²½一日本éàß😀👍🏽#$%^&*՘\U0003d000\U000323b0₏"
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 50))) for _ in range(3_000)]
    texts += ["a" * 3_000, " " * 999, "=-" * 300, "ha" * 500, "x<|endoftext|> <|endoftext|>y"]
    for text, ids in zip(texts, bpe.encode_texts(tokens, texts)):
        assert bpe.parse_ids(ids) == library.encode(text, add_special_tokens=False).ids, text


def test_compatible_pairs_are_those_that_merging_leaves_alone(tokens):
    draw = np.random.default_rng(3)
    left, right = draw.integers(0, 50_000, (2, 4_000))
    left[:500], right[:500] = draw.integers(0, 400, (2, 500))
    fine = bpe.compatible(tokens, left, right)
    for a, b, ok in zip(left.tolist(), right.tolist(), fine):
        word = tokens["token_bytes"][a] + tokens["token_bytes"][b]
        assert (bpe.merge_exactly(tokens, word) == [a, b]) == ok
        assert bpe.merge_long(tokens, word) == bpe.merge_exactly(tokens, word)
    assert 0 < fine.sum() < len(fine)


def test_a_full_memory_starts_afresh(tokens, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 3)
    texts = ["one two three four five six"] * 600 + ["one seven"]
    got = [bpe.parse_ids(ids) for ids in bpe.encode_texts(tokens, texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


# Pipeline


def test_pipeline_equals_brute_force(spark, tables, library):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    got = corpus_pipeline.run(spark, tables)
    # Languages are learnt: taken from the operator. All stages after it in plain Python.
    languages = {r.doc_id: r for r in language_id.language_query(docs).collect()}
    rows = [r for r in docs.collect() if languages[r.doc_id].lang_pred != "und" and languages[r.doc_id].score >= 0.4]
    texts = {i: t for i, _, _, t in brute_lines([(r.doc_id, r.text) for r in rows], 10)}
    rows.sort(key=lambda r: r.doc_id)
    prints = [brute_fingerprint(texts[r.doc_id]) for r in rows]
    label = groups(len(rows), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    rows = [r for k, r in enumerate(rows) if label[k] == k]
    assert len(rows) < docs.count()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(WORD.findall(texts[r.doc_id]))
    targets, expected = brute_targets(sizes), []
    for r in rows:
        rate = targets[r.source] / sizes[r.source] if sizes[r.source] else 0.0
        u = int(hashlib.md5(f"0:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        expected += [(r.doc_id, *digests(library, texts[r.doc_id]))] * (int(rate) + (u < rate - int(rate)))
    assert found(got) == sorted(expected, key=repr)


def test_pipeline_stages_keep_the_columns(spark, awkward, nothing):
    from bucketlens.session import staged

    for given in (awkward, nothing):
        docs = given
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = staged(stage(spark, docs, ""), f"test-{name}")
            assert docs.columns == given.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_nothing_outside_imports_the_package():
    root = Path(corpus_pipeline.__file__).parent
    for file in [*root.glob("bucketlens/**/*.py"), *root.glob("registry/*.py")]:
        if "llm" not in file.parts:
            assert "bucketlens.llm" not in file.read_text()
