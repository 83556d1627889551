"""Edge cases of the corpus operators: nulls, empty and long texts, ties, repeated rows, empty tables, odd names."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eavista.llm import (
    bloom, bpe, components, exact_chunks, line_dedup, mixing, quality_qda, quality_rules, recompression, secret_scan,
    simhash_dedup, substring_dedup, url_filter,
)
from tests.llm.conftest import CLASHING, COLUMNS, PROSE, odd_rows, unlike
from tests.llm.test_queries import components_by_force, repeats_by_force

LABELS = "doc_id long, quality int"
PER_ROW = {
    "bpe": bpe.round_trip,
    "quality": quality_rules.quality,
    "lines": line_dedup.deduplicated,
    "substrings": substring_dedup.deduplicated,
    "simhash": simhash_dedup.near_duplicates,
    "exact": exact_chunks.exact_duplicates,
    "mixing": mixing.mixture,
    "secrets": secret_scan.secrets,
    "classifier": lambda docs: quality_qda.classify(
        docs, docs.sparkSession.createDataFrame([(4, 1), (12, 0), (9, 1), (13, 0), (99, None)], LABELS)
    ),
}
KEEPING = {
    "quality": quality_rules.clean,
    "lines": line_dedup.remove_boilerplate,
    "substrings": substring_dedup.remove_repeats,
    "simhash": simhash_dedup.drop_near_duplicates,
    "exact": exact_chunks.drop_exact_duplicates,
    "mixing": mixing.sample,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_every_row(odd, clashing, nothing, name):
    rows = PER_ROW[name](odd).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_rows())
    assert sorted(map(str, PER_ROW[name](clashing).collect())) == sorted(map(str, rows))
    assert PER_ROW[name](nothing).collect() == []


@pytest.mark.parametrize("name", KEEPING)
def test_kept_rows_keep_their_columns(clashing, nothing, name):
    kept = KEEPING[name](clashing)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    assert rows and all(tuple(r[c] for c in CLASHING) == tuple(range(len(CLASHING))) for r in rows)
    assert KEEPING[name](nothing).collect() == []


LIBRARY = Tokenizer.from_file(bpe.vocabulary_path())
CODEC = bpe.Codec(bpe.Vocabulary(bpe.vocabulary_path()))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aabcdeinthe'sdΣςİÉé \t\n漢字🙂0٣.,!"), max_size=80))
def test_bpe_of_any_text(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert CODEC.encode(text) == ids
    assert CODEC.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "a" * 5000, "ab" * 4000, "inthethan" * 900, "!" * 3000,
    "᾽ \u209e\ua7ce ꟌA",
])
def test_bpe_of_odd_words(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert CODEC.encode(text) == ids and CODEC.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_bpe_columns(spark, odd):
    rows = odd.select("text", bpe.encoder(spark, bpe.vocabulary_path())(F.col("text")).alias("ids")).select(
        "text", "ids", bpe.decoder(spark, bpe.vocabulary_path())(F.col("ids")).alias("decoded")
    ).collect()
    assert all(r.ids == LIBRARY.encode(r.text or "", add_special_tokens=False).ids for r in rows)
    assert all(r.decoded == LIBRARY.decode(r.ids, skip_special_tokens=False) for r in rows)


def test_repeated_words_are_exact():
    rng = random.Random(3)
    for _ in range(50):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 60))]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        assert quality_rules.repeated_words(words) == len(inside)


def test_quality_lines():
    good = ". ".join(unlike(i, 12) for i in range(4)) + "."
    verdict = quality_rules.judge_text(good + "\nHome | News | About | Shop\n" + "BUY!! NOW!! CHEAP!! THINGS!!")
    assert verdict[6] and verdict[8] == 2 and verdict[10] == good
    assert not quality_rules.judge_text("a b c")[6]
    assert not quality_rules.judge_text("\n".join(f"*{i}* $$$ ### &&& {i}x" for i in range(30)))[6]


def test_texts_are_judged_once(odd):
    plan = quality_rules.clean(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_classifier_without_a_class(spark, odd):
    rows = quality_qda.classify(odd, spark.createDataFrame([(4, 1)], LABELS)).collect()
    assert {r.score for r in rows} == {0.5}


def test_classifier_never_learns_from_held_out_rows(spark):
    docs = spark.createDataFrame([(i, unlike(i, 20 + i % 7)) for i in range(60)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    turned = labels.withColumn(
        "quality", F.when(quality_qda.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    scores = [
        {r.doc_id: round(r.score, 9) for r in quality_qda.classify(docs, given).collect()} for given in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_secrets_by_models(spark):
    rng = random.Random(1)
    key = lambda n: "".join(rng.choice("ABCDEFGHJKMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz0123456789") for _ in range(n))
    names = ["connection_pool_manager", "maximumRetryInterval", "user_profile_settings", "applicationServerName"]
    rows = [(i, f"token = {key(32)} then {names[i % 4]} here") for i in range(200)]
    rows.append((1000, "é🙂 " + (hidden := key(40)) + " and connection_pool_interval"))
    found = {r.doc_id: r for r in secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1000].spans == f"random:3:{3 + len(hidden)}"
    assert all(found[i].n_assign == 1 and "random" not in found[i].spans for i in range(200))


def test_many_matches_in_one_text(spark):
    text = " ".join(["password=abcdef"] * 700)
    row = secret_scan.secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.spans.split(",") == [f"assign:{16 * i}:{16 * i + 15}" for i in range(700)]


def test_failing_match_is_dropped_not_tried_again(spark):
    row = secret_scan.secrets(spark.createDataFrame([(1, "secret=token:abcdefgh")], "doc_id long, text string")).first()
    assert row.n_assign == 0 and row.spans == ""


def test_raked_margins_meet_their_targets(spark, odd):
    rows = [(i, unlike(i, 5 + i % 11), f"l{i % 3}", f"s{i % 5}", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, COLUMNS)
    targets = {"lang": spark.createDataFrame([("l0", 0.6), ("l1", 0.3), ("l2", 0.1)], "value string, share double")}
    cells = mixing.calibrated(docs, targets, keep=0.5).toPandas()
    assert cells.groupby("lang").weight.sum().round(3).to_dict() == {"l0": 0.6, "l1": 0.3, "l2": 0.1}
    kept = (cells.share * cells.probability).groupby(cells.lang).sum()
    assert (kept / kept.sum()).round(3).to_dict() == {"l0": 0.6, "l1": 0.3, "l2": 0.1}
    assert abs(kept.sum() - min(0.5, (cells.share / cells.weight).min())) < 1e-6 and cells.probability.max() <= 1
    chosen = mixing.sample(docs, targets, keep=0.5)
    assert sorted(chosen.collect()) == sorted(mixing.sample(docs, targets, keep=0.5).collect())


def test_raking_of_sparse_cells_converges(spark):
    rng = np.random.default_rng(1)
    places = np.array([(s, l, t) for s in range(60) for l in range(8) for t in range(4) if rng.random() < 0.4])
    share = rng.lognormal(0, 2, 60)[places[:, 0]] * rng.lognormal(0, 1.5, len(places))
    share /= share.sum()
    own = [np.bincount(places[:, m], share) for m in range(3)]
    targets = [o**p / (o**p).sum() for o, p in zip(own, mixing.POWER.values())]
    wanted = share.copy()
    for _ in range(500):
        for m in range(3):
            wanted *= (targets[m] / np.bincount(places[:, m], wanted))[places[:, m]]
    rows = [
        (*(f"{n}" for n in p), float(share[i]), *(float(targets[m][p[m]]) for m in range(3)), float(wanted[i]))
        for i, p in enumerate(places)
    ]
    kinds = [f"{m} string" for m in mixing.MARGINS] + ["share double"] + [f"target_{m} double" for m in mixing.MARGINS]
    cells = spark.createDataFrame(rows, ", ".join([*kinds, "wanted double"]))
    raked = mixing.rake(cells, tolerance=1e-5).toPandas()
    assert set(raked.columns) == {*cells.columns, "weight"}
    for margin in mixing.MARGINS:
        by = raked.groupby(margin)
        assert (by.weight.sum() / by[f"target_{margin}"].max() - 1).abs().max() <= 1e-5
    assert (raked.weight / raked.wanted - 1).abs().max() < 1e-4


def test_default_targets_are_met_by_the_sample_in_expectation(spark):
    rng = np.random.default_rng(2)
    rows = [
        (i, unlike(i, int(rng.integers(1, 300))), f"l{int(rng.zipf(1.7)) % 4}", f"s{int(rng.zipf(1.4)) % 9}", 0) for i in range(1500)
    ]
    cells = mixing.calibrated(spark.createDataFrame(rows, COLUMNS)).toPandas()
    kept = cells.share * cells.probability
    assert abs(kept.sum() - mixing.KEEP) < 1e-5 and cells.probability.max() <= 1
    for margin in mixing.MARGINS:
        found, by = kept.groupby(cells[margin]).sum() / kept.sum(), cells.groupby(margin)
        target, own = by[f"target_{margin}"].max(), by[f"own_{margin}"].max()
        assert (found / target - 1).abs().max() < 1e-3
        wish = own ** mixing.POWER[margin] / (own ** mixing.POWER[margin]).sum()
        assert ((target - own) * (wish - own) >= -1e-12).all() and (target - own).abs().max() > 1e-3


def test_full_targets_are_met_by_copies_of_the_share_to_keep(spark):
    """Expected copies meet the full powers of the own shares and hold KEEP of the tokens; copies round them by chance."""
    rng = np.random.default_rng(2)
    rows = [
        (i, unlike(i, int(rng.integers(1, 300))), f"l{int(rng.zipf(1.7)) % 4}", f"s{int(rng.zipf(1.4)) % 9}", 0) for i in range(1500)
    ]
    docs = spark.createDataFrame([*rows, (1500, None, "l9", None, 0)], COLUMNS)
    cells = mixing.calibrated(docs, repeats=True).toPandas()
    kept = cells.share * cells.expected
    assert abs(kept.sum() - mixing.KEEP) < 1e-5 and cells.expected.max() > 2 and cells.probability.max() <= 1
    for margin in mixing.MARGINS:
        own = cells.share.groupby(cells[margin]).sum()
        wish = own ** mixing.POWER[margin] / (own ** mixing.POWER[margin]).sum()
        assert (kept.groupby(cells[margin]).sum() / kept.sum() / wish - 1).abs().max() < 1e-3
    expected = {(r.source, r.lang, r.topic): r.expected for r in cells.itertuples()}
    found = mixing.mixture(docs, repeats=True).collect()
    assert len(found) == 1501 and {r.doc_id: r.copies for r in found}[1500] == 1
    for r in found:
        wanted = expected.get((r.source, r.lang, r.topic), 1.0)
        assert r.copies - int(wanted) in (0, 1) and r.selected == (r.copies > 0) and r.probability == min(wanted, 1.0)
    assert abs(sum(r.copies * r.n_tokens for r in found) / sum(r.n_tokens for r in found) - mixing.KEEP) < 0.05
    drawn = mixing.sample(docs, repeats=True)
    assert drawn.columns == docs.columns
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r.doc_id for r in found for _ in range(r.copies))


def test_weights_and_targets_move_back_until_no_cell_is_kept_more_than_whole(spark):
    names = [f"own_{m} double, target_{m} double" for m in mixing.MARGINS]
    rows = [(0.5, 0.2, *[0.5, 0.2] * 3), (0.4, 0.4, *[0.4, 0.4] * 3), (0.1, 0.4, *[0.1, 0.4] * 3)]
    cells = spark.createDataFrame(rows, ", ".join(["share double, weight double", *names]))
    for keep in (0.2, 0.5, 0.9, 1.0):
        found = mixing.probabilities(mixing.within_reach(cells, keep), keep).toPandas()
        part = min(1, (1 / keep - 1) / 3)
        assert abs((found.share * found.probability).sum() - keep) < 1e-5
        assert np.allclose(found.weight, found.share + part * np.array([-0.3, 0, 0.3]))
        assert all(np.allclose(found.weight, found[f"target_{m}"]) for m in mixing.MARGINS)
    with pytest.warns(UserWarning, match="0.25 of all tokens"):
        found = mixing.probabilities(cells, 0.5).toPandas()
    assert np.allclose(found.probability, [0.1, 0.25, 1.0])


def test_many_cells_are_joined_by_parts(spark, monkeypatch):
    rows = [(i, unlike(i, 1 + i % 7), f"l{i % 2}", f"s{i % 3}", 0) for i in range(60)] + [(60, None, None, None, 0)] * 2
    docs = spark.createDataFrame(rows, COLUMNS)
    sent = sorted(mixing.mixture(docs).collect(), key=repr)
    monkeypatch.setattr(mixing, "SENT_CELLS", 0)
    assert len(sent) == 62 and sorted(mixing.mixture(docs).collect(), key=repr) == sent


def test_targets_that_contradict_end_with_a_warning(spark):
    rows = [("a", "x", "t", 0.5, 0.7, 0.4, 1.0), ("b", "y", "t", 0.5, 0.3, 0.6, 1.0)]
    kinds = "source string, lang string, topic string, share double, target_source double, target_lang double, target_topic double"
    with pytest.warns(UserWarning, match="can not all be met"):
        raked = mixing.rake(spark.createDataFrame(rows, kinds)).collect()
    assert {r.source: round(r.weight, 6) for r in raked} == {"a": 0.4, "b": 0.6}


def test_lines_near_the_threshold_are_counted_exactly(spark):
    lines = {f"line with spread {n} here": n for n in (1, 3, 4, 5, 6, 7, 30)}
    rows = [
        (100 * k + site, unlike(100 * k + site, 30) + "\n" + line, "en", f"site{site}", 0)
        for k, (line, spread) in enumerate(lines.items()) for site in range(spread)
    ]
    # Many copies on one site are no spread.
    rows += [(9000 + i, unlike(9000 + i, 30) + "\nline with spread 1 here", "en", "site0", 0) for i in range(50)]
    docs = spark.createDataFrame(rows, COLUMNS)
    left = [r.text for r in line_dedup.remove_boilerplate(docs).collect()]
    for line, spread in lines.items():
        assert any(line in text for text in left) == (spread < line_dedup.SITES)


def test_footer_goes_and_copies_stay(spark, odd):
    texts = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(odd).collect()}
    assert all("footer" not in texts[i] for i in range(15, 20))
    assert texts[19] == unlike(19, 20) + "\n" + unlike(190, 20)
    page = "A whole page that is copied.\nIt has a second line."
    copies = spark.createDataFrame([(i, page, "en", f"s{i}", 0) for i in range(9)], COLUMNS)
    assert {r.text for r in line_dedup.remove_boilerplate(copies).collect()} == {page}


def test_mostly_boilerplate_goes_unless_it_is_a_copy(spark):
    footer = "A long footer that stands on every page of all the sites."
    rows = [(i, f"own {i}\n{footer}", "en", f"s{i}", 0) for i in range(6)]
    rows += [(20, footer, "en", "s1", 0), (20, footer, "en", "s1", 0), (21, f"{footer}\n\n{footer}\n", "en", "s2", 0)]
    left = {(r.doc_id, r.text) for r in line_dedup.remove_boilerplate(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert left == {(i, f"own {i}") for i in range(6)} | {(20, ""), (21, "\n")}


def test_boilerplate_in_scripts_without_spaces(spark):
    lines = ("版权所有，未经许可不得转载", "このサイトについてのお問い合わせ", "สงวนลิขสิทธิ์ทุกประการ")
    short = "首页"
    rows = [(10 * k + i, f"{unlike(10 * k + i, 30)}\n{line}\n{short}", "zh", f"s{i}", 0) for k, line in enumerate(lines) for i in range(5)]
    left = [r.text for r in line_dedup.remove_boilerplate(spark.createDataFrame(rows, COLUMNS)).collect()]
    assert all(text.endswith(f"\n{short}") and not any(line in text for line in lines) for text in left)


def test_text_is_shuffled_once(spark, odd):
    """The row is carried through the join with its text in it, and no second copy beside it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = line_dedup.remove_boilerplate(odd)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [line for line in plan.splitlines() if "Project" in line and "AS row#" in line]
    assert len(scans) == 1 and " AS text#" not in scans[0]


PAGES = "page_id long, url string"


def test_url_cases(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "x://example.com/en/", "x://example.com/en",
        "x://a.www.example.com/en/y?q#f", "http://a.net/es/", "http://anet/es/", "http://com", "http://com/",
        "http://É.net/fr/1", "x://y://z.com/p", "http://bad.org/p/?utm_source=a&id=3#t", "http://bad.org/p?id=3",
        "http://bad.org/p?id=4", "http://bad.org/p?id=3",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), PAGES)
    listed = spark.createDataFrame([("bad.org/p?id=3",), ("bad.org/p?id=3",), (None,)], "canonical string")
    rows = {r.page_id: r for r in url_filter.judge(pages, listed).collect()}
    assert [(rows[i].host, rows[i].path, rows[i].rule, rows[i].verdict) for i in range(len(urls))] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("www.example.com", "/en/x", "www.example.com/en/", "allow"), ("example.com", "/en/", "example.com/en/", "block"),
        ("example.com", "/en", "com/", "allow"), ("a.www.example.com", "/en/y", "www.example.com/en/", "allow"),
        ("a.net", "/es/", "net/es/", "block"), ("anet", "/es/", None, "allow"), ("com", "", None, "allow"),
        ("com", "/", "com/", "allow"), ("É.net", "/fr/1", "net/fr/", "block"), ("y:", "//z.com/p", None, "allow"),
        ("bad.org", "/p/", None, "block"), ("bad.org", "/p", None, "block"), ("bad.org", "/p", None, "allow"),
        ("bad.org", "/p", None, "block"),
    ]
    assert url_filter.judge(pages, listed.limit(0)).filter("listed").count() == 0
    assert url_filter.judge(pages.limit(0), listed).collect() == []


def test_full_bloom_filter_changes_no_verdict(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 300}.org/{i % 7}") for i in range(3000)], PAGES)
    listed = spark.createDataFrame([(f"h{i}.org/{i % 7}",) for i in range(150)], "canonical string")
    results = [sorted(url_filter.judge(pages, listed, block_bits=bits).collect()) for bits in (1, 14)]
    assert results[0] == results[1] and sum(r.listed for r in results[0]) > 0


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).withColumnRenamed("id", "k")
    maybe = bloom.tester(spark, bloom.build(keys, "k", 10))
    assert keys.filter(maybe(F.col("k"))).count() == 5000
    others = spark.range(100_000, 110_000).filter(maybe(F.col("id"))).count()
    assert others < 1000


def test_masks_cover_every_small_difference():
    rng = random.Random(2)
    for open_bits in (simhash_dedup.FULL, 0xFFFF0000FF00F0F1, 0b1111111111):
        masks = simhash_dedup.covering_masks(open_bits)
        places = [i for i in range(64) if open_bits >> i & 1]
        assert all(m & ~open_bits == 0 for m in masks)
        for _ in range(2000):
            difference = sum(1 << p for p in rng.sample(places, 4))
            assert any(m & difference == 0 for m in masks)


@pytest.mark.parametrize("size", [40, 512])
def test_links_connect_what_brute_force_connects(spark, size):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    values = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for c in centres for _ in range(60)}
    values = np.array(sorted(values | {int(v) for v in rng.integers(0, 2**63, 200, dtype=np.uint64)}), np.uint64)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    rooted = components.components(simhash_dedup.links(frame, size)).collect()
    root = {r.node: r.root for r in rooted}
    signed = values.view(np.int64).tolist()
    found = {}
    for v in signed:
        found.setdefault(root.get(v, v), set()).add(v)
    wanted = {}
    for v, c in zip(signed, components_by_force(values, signed)):
        wanted.setdefault(c, set()).add(v)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, wanted.values()))


def test_finer_masks_add_bits():
    rng = random.Random(6)
    for n in range(simhash_dedup.RADIUS + 1, 65):
        places = rng.sample(range(64), n)
        masks = simhash_dedup.covering_masks(sum(1 << p for p in places))
        assert all(masks), n
        for _ in range(300):
            difference = sum(1 << p for p in rng.sample(places, simhash_dedup.RADIUS))
            assert any(m & difference == 0 for m in masks)


@pytest.mark.parametrize("size", [4, 512])
def test_links_in_a_large_bucket_of_few_open_bits(spark, size):
    full, found = simhash_dedup.FULL, []
    for first in simhash_dedup.covering_masks(full):
        for second in simhash_dedup.covering_masks(full & ~first):
            assert second
            if 10 <= 64 - (first | second).bit_count() <= 15:
                found.append(full & ~(first | second))
    places = [i for i in range(64) if found[0] >> i & 1]
    # Over 512 in one bucket of both levels, and some far from them.
    picked = random.Random(8).sample(range(1 << len(places)), 900)
    near = [sum(1 << p for k, p in enumerate(places) if v >> k & 1) for v in picked]
    values = np.array(sorted({*near, *(v ^ full for v in near[:100])}), np.uint64)
    signed = values.view(np.int64).tolist()
    rooted = components.components(simhash_dedup.links(spark.createDataFrame([(v,) for v in signed], "fp long"), size))
    root = {r.node: r.root for r in rooted.collect()}
    groups = {}
    for v in signed:
        groups.setdefault(root.get(v, v), set()).add(v)
    wanted = {}
    for v, c in zip(signed, components_by_force(values, signed)):
        wanted.setdefault(c, set()).add(v)
    assert len(near) > simhash_dedup.BUCKET and sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_large_buckets_are_dealt_to_parts(spark):
    rows = spark.range(3000).select(F.col("id").alias("fp"), F.lit(~0xFFF).cast("long").alias("mask"))
    rows = rows.unionByName(spark.createDataFrame([(1 << 40, ~0xFFF), ((1 << 40) + 1, ~0xFFF), (1 << 50, ~0xFFF)], rows.schema))
    found = simhash_dedup._buckets(rows, 512)
    plan = found._jdf.queryExecution().toString()
    assert "Window" not in plan and "Sort [fp" not in plan
    members = found.toPandas()
    parts = members[members.agreed == 0].groupby("part").fp.nunique()
    assert len(parts) == 6 and parts.sum() == 3000 and parts.max() < 700
    assert members[members.agreed == 0].large.all() and not members[members.agreed != 0].large.any()
    assert sorted(members[members.agreed != 0].fp) == [1 << 40, (1 << 40) + 1]


def test_components_of_a_long_path(spark):
    links = spark.range(64).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rows = components.components(links).collect()
    assert len(rows) == 65 and {r.root for r in rows} == {0}


def test_one_document_of_each_near_duplicate_group_stays(spark):
    base = unlike(1, 400)
    rows = [(i, base + f" end{i}", "en", "s", 0) for i in range(5, 15)] + [(99, unlike(2, 400), "en", "s", 0)]
    kept = simhash_dedup.drop_near_duplicates(spark.createDataFrame(rows, COLUMNS))
    assert sorted(r.doc_id for r in kept.collect()) == [5, 99]


def test_repeated_ids_leave_one_row_of_each_group(spark):
    base, other = unlike(1, 400), unlike(2, 400)
    rows = [(5, base + " end1", "en", "s", 0), (5, base + " end2", "en", "s", 0), (5, base + " end2", "en", "s", 0)]
    rows += [(6, base + " end3", "en", "s", 0), (1, other, "en", "s", 0), (5, other + " end", "en", "s", 0)]
    rows += [(None, unlike(3, 400), "en", "s", 0), (None, unlike(4, 400), "en", "s", 0)]
    kept = simhash_dedup.drop_near_duplicates(spark.createDataFrame(rows, COLUMNS)).collect()
    assert sorted((r.doc_id or 0, r.text.split()[0]) for r in kept) == [(0, "w3x0"), (0, "w4x0"), (1, "w2x0"), (5, "w1x0")]


def texts_of(rows):
    return {r[0]: r[1] or "" for r in rows}


def removed(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.deduplicated(docs).collect()}


def test_substrings_with_runs_periods_and_chains(spark):
    rng = random.Random(7)
    common = [unlike(50 + i, rng.randint(40, 140)) for i in range(12)]
    texts = {i: " ".join(rng.choice([*common, unlike(1000 + i, rng.randint(1, 60)), "a " * rng.randint(1, 130),
                                     "a b c " * rng.randint(1, 60)]) for _ in range(6)) for i in range(120)}
    texts[500] = texts[3]
    texts[501] = texts[3] + " tail"
    texts[502] = "x " * 49
    texts[503] = "x " * 50
    texts[504] = "x " * 55
    assert removed(spark, texts) == repeats_by_force(texts)


def test_substrings_of_odd_rows(odd, spark):
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 7]
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.deduplicated(odd).collect()}
    wanted = repeats_by_force(texts_of(rows))
    assert {k: found[k] for k in wanted} == wanted


def test_own_text_of_an_id_with_a_copied_text(spark):
    copied, shared = unlike(1, 200), unlike(2, 120)
    rows = [(1, copied), (2, shared + " " + unlike(3, 60)), (5, copied), (5, unlike(4, 60) + " " + shared), (9, copied)]
    found = substring_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in found) == [
        (1, 200, 0), (2, 180, 0), (5, 180, 120), (5, 200, 200), (9, 200, 200)
    ]


def test_anchors_depend_on_their_context_only():
    rng = random.Random(4)
    words = [f"v{rng.randint(0, 30)}".encode() for _ in range(4000)]
    names = recompression.word_names(words)
    place = np.arange(len(names))
    whole = recompression.anchors(names, np.zeros(len(names), np.int64), place)
    expected = {(int(n), int(lo)) for n, lo, hi in zip(whole.name, whole.low, whole.high) if 1000 <= lo and hi <= 1100}
    cut = recompression.anchors(names[1000:1100], np.zeros(100, np.int64), np.arange(100))
    found = {(int(n), int(lo) + 1000) for n, lo, hi in zip(cut.name, cut.low, cut.high) if lo >= 0 and hi <= 100}
    assert expected == found and expected


def test_chunks_make_the_text(odd):
    text = F.coalesce(F.col("text"), F.lit(""))
    assert odd.filter(F.array_join(exact_chunks.chunks(text), "") != text).count() == 0


def test_exact_groups(odd):
    rows = {(r.doc_id, r.text_sha256): r for r in exact_chunks.exact_duplicates(odd).collect()}
    by_id = {r.doc_id: r for r in rows.values() if r.doc_id is not None}
    assert (by_id[1].keep_id, by_id[2].keep_id, by_id[1].group_size) == (2, 2, 3)
    assert (by_id[7].keep_id, by_id[7].group_size, by_id[7].kept, by_id[8].kept) == (8, 3, False, True)


def test_ambiguous_identifiers_are_told_apart_by_content(spark):
    weak = lambda chunk: F.struct(F.char_length(chunk).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    docs = spark.createDataFrame([(1, "abc"), (2, "xyz"), (3, "abc"), (4, PROSE)], "doc_id long, text string")
    rows = {r.doc_id: r for r in exact_chunks.exact_duplicates(docs, weak).collect()}
    assert [(rows[i].keep_id, rows[i].group_size) for i in range(1, 5)] == [(3, 2), (2, 1), (3, 2), (4, 1)]


def test_one_text_stays_once_where_ids_repeat_on_other_texts(spark):
    docs = spark.createDataFrame([(5, "A"), (6, "A"), (5, "B"), (4, "B"), (None, "C"), (None, "")], "doc_id long, text string")
    kept = exact_chunks.drop_exact_duplicates(docs).collect()
    assert sorted((r.text, r.doc_id or 0) for r in kept) == [("", 0), ("A", 6), ("B", 5), ("C", 0)]
