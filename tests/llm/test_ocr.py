import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernwork.llm import ocr_words, p2_ocr
from quernwork.llm.boost import Boosted

PAGES, LEXICON = "newspapers", "lexicon"


@pytest.fixture(scope="module")
def tables(spark, smoke_dir):
    return spark.read.parquet(f"{smoke_dir}/newspapers.parquet"), spark.read.parquet(f"{smoke_dir}/lexicon.parquet")


@pytest.fixture(scope="module")
def made(tables):
    """Records with known furniture, divisions and misreadings, beside the given ones."""
    pages, lexicon = tables
    spark = pages.sparkSession
    text = (
        "THE OAKHAM HERALD\nThe people of the town were certain that the har-\n- 12 -\nvest was good, and the"
        " wcather\nwas calm. A well-\nknown captain carried the ev¬\nening letter.\n\nThc mar|ket was open until\n1886.\nvii\n"
    )
    rows = [(900_000 + i, "p/1880/x", "zz1", "b", text) for i in range(6)] + [(900_001, "p", "zz1", "b", text)]
    rows += [(910_000, None, None, None, None), (910_001, None, None, None, ""), (910_002, None, None, None, "-\n-\n"), (None, None, "zz1", None, text)]
    extra = spark.createDataFrame(rows, "page_id bigint, member_path string, lccn string, batch_name string, text string")
    return pages.drop("loaded_at").unionByName(extra), lexicon


def test_items(made):
    found = p2_ocr.page_items(*made)
    got = {(r.kind, r.item) for r in found.filter("page_id = 900001").collect()}
    assert ("header", "THE OAKHAM HERALD") in got
    assert {("page_number", "- 12 -"), ("page_number", "vii")} <= got and ("page_number", "1886.") not in got
    assert {("hyphenation", "harvest"), ("hyphenation", "well-known"), ("hyphenation", "evening")} <= got
    assert ("misread", "market") in got
    assert found.count() == found.distinct().count() and found.filter("page_id >= 910000 or page_id is null").count() == 0


def test_repaired(made):
    rows = {r.page_id: r for r in p2_ocr.repair(*made).filter("page_id >= 900000").collect()}
    text = rows[900_002].repaired
    assert "that the harvest was good" in text and "A well-known captain carried the evening letter." in text
    assert "OAKHAM HERALD" not in text and "12" not in text and "market" in text and text.count("\n\n") == 1
    assert rows[910_000].repaired is None and rows[910_001].repaired == ""


def test_repaired_alike_however_the_misread_words_come(made):
    ways = [p2_ocr.repair(*made, most_fixes=n).select("page_id", "text", "repaired").collect() for n in (1 << 17, 0)]
    assert sorted(map(repr, ways[0])) == sorted(map(repr, ways[1])) and len(ways[0]) == made[0].count()
    assert any(r.page_id is None and "market" in r.repaired for r in ways[1])


def test_empty_tables(tables):
    pages, lexicon = tables
    assert p2_ocr.page_items(pages.limit(0), lexicon).count() == 0
    assert p2_ocr.repair(pages.limit(0), lexicon).count() == 0


def test_ranking_on_held_out_misreadings(tables):
    words = {r.word: r.is_common for r in tables[1].collect()}
    model = ocr_words.fit_ranking(words, [])
    find, rng = ocr_words.Retrieval(sorted(words)), random.Random(77)
    plausible = ocr_words.Plausible(sorted(words))
    common = {w for w, c in words.items() if c}
    right = tried = seen = 0
    for word in sorted(words):
        token = ocr_words.corrupt(word, rng)
        if token in words or len(word) < 4:
            continue
        tried += 1
        candidates = find(token)
        seen += plausible(token)
        if candidates:
            score = model.probability(ocr_words.features(token, candidates, common))
            right += candidates[int(score.argmax())] == word
    assert right >= 0.95 * tried and seen >= 0.92 * tried


def test_alignment():
    assert ocr_words.alignment("wcather", "weather")[:2] == (1.0, 1)
    assert ocr_words.alignment("moming", "morning")[2] == 0 and ocr_words.alignment("ba|rn", "barn")[2] == 0
    assert ocr_words.alignment("zebra", "horse")[0] > 6


def test_boosting_learns_and_handles_nothing():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = Boosted(x[:400], y[:400])
    assert ((model.probability(x[400:]) > 0.5) == y[400:]).mean() > 0.9
    assert model.one(list(x[0])) == pytest.approx(model.probability(x[:1])[0])
    assert len(Boosted(np.zeros((0, 2)), np.zeros(0)).probability(np.zeros((3, 2)))) == 3


def test_names_are_told_by_their_share_of_the_records(tables):
    pages, lexicon = tables
    spark = pages.sparkSession
    line = "the people of the town were certain that the harvest was good and the {} was open in the morning"
    texts = [line.format("market")] * 200 + [f"Markct day, {line.format('house')}"] * 8 + [f"Halter said that {line.format('house')}"] * 60
    rows = [(950_000 + i, "p/1880/x", "zz2", "b", text) for i, text in enumerate(texts)]
    extra = spark.createDataFrame(rows, "page_id bigint, member_path string, lccn string, batch_name string, text string")
    found = p2_ocr.page_items(pages.drop("loaded_at").unionByName(extra), lexicon).filter("page_id >= 950000 and kind = 'misread'")
    assert sorted((r.page_id, r.item) for r in found.collect()) == [(950_200 + i, "market") for i in range(8)]


def test_models_are_fitted_on_every_record_and_token(tables):
    pages, lexicon = tables
    spark = pages.sparkSession
    words = {r.word.lower(): r.is_common for r in lexicon.collect()}
    said = sorted(w for w in words if len(w) > 6)[:40]
    rows = [(i, f"zz{i % 3}", f"THE OAKHAM HERALD\nno {said[i % 40]} in 1886 was har-\nvest\n- {i % 90} -\n") for i in range(1700)]
    rows += [(2000, "zz1", f"{said[0]} was\n" * 9000), (2001, None, said[0]), (2002, "zz2", ""), (2003, "zz2", None)]
    models, _ = p2_ocr.line_models(spark.createDataFrame(rows, "page_id bigint, lccn string, text string").repartition(7), lexicon)
    on = {w: sum(w in {p2_ocr.bare(t).lower() for t in (text or "").split()} for _, _, text in rows) for w in words}
    n = sum(text is not None for _, _, text in rows)
    assert models.shares == {w: pytest.approx((on[w] + p2_ocr.MORE_RECORDS) / n) for w in words} and on[said[0]] == 45
    # the lines' rows and their weights are those of all texts
    counts = p2_ocr.LineCounts(set(words))
    for _, title, text in rows:
        if text is not None:
            counts.add(title, text)
    for model, kind in ((models.number, "number"), (models.join, "join")):
        mine = [r for r in counts.rows() if r[0] == kind]
        x, y, weight = (np.array([r[i] for r in mine], np.float64) for i in (4, 5, 6))
        whole = Boosted(x, y, weight=weight)
        assert model.probability(x) == pytest.approx(whole.probability(x), abs=1e-9) and len(model.trees) == len(whole.trees)
    assert sum(r[6] for r in counts.rows() if r[0] == "number") == 3400 and sum(r[6] for r in counts.rows() if r[0] == "header") == 1700


def test_ranking_is_fitted_on_all_words_and_all_names(tables, monkeypatch):
    lexicon = tables[1]
    spark = lexicon.sparkSession
    words = {r.word.lower(): r.is_common for r in lexicon.collect()}
    shares = dict.fromkeys(words, 0.5)
    capitals = sorted({w[:-1].capitalize() + e for w in words if len(w) > 3 and w.isalpha() for e in "kyz"} - {w.capitalize() for w in words})
    assert len(capitals) > 2000
    fitted = {}
    fit = p2_ocr.fit_counted
    monkeypatch.setattr(p2_ocr, "fit_counted", lambda rows, widths: fitted.update(rows=rows.collect()) or fit(rows, widths))
    odd = spark.createDataFrame([(i, t) for t in capitals for i in range(2)], "page_id bigint, item string")
    p2_ocr.meant_words(odd, lexicon, shares, 2).count()
    find, common, want = ocr_words.Retrieval(sorted(words)), {w for w, c in words.items() if c}, {}
    pairs = [ocr_words.name_rows(t, [2.0] * len(c), c, common) for t in capitals if (c := find(t))]
    for w in sorted(words):
        pairs += [ocr_words.made_rows(w, *made, find(made[0]), common) for made in ocr_words.made_tokens(w, words)]
    for x, y in pairs:
        for row, label in zip(map(tuple, np.concatenate(x).tolist()) if x else (), y):
            want[row, label] = want.get((row, label), 0) + 1
    got = {}
    for r in fitted["rows"]:
        got[tuple(r.row), r.label] = got.get((tuple(r.row), r.label), 0) + r.n
    assert got == want


def test_counted_rows_fit_as_repeated_ones(tables):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(300, 3)), 1)
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    weight = rng.integers(1, 9, 300)
    whole = Boosted(np.repeat(x, weight, axis=0), np.repeat(y, weight))
    assert Boosted(x, y, weight=weight).probability(x) == pytest.approx(whole.probability(x))
    rows = tables[0].sparkSession.createDataFrame(
        [("m", list(map(float, r)), float(label), float(n)) for r, label, n in zip(x, y, weight)], p2_ocr.ROWS
    )
    assert p2_ocr.fit_counted(rows, {"m": 3})["m"].probability(x) == pytest.approx(whole.probability(x))
    # too many different rows: wider bins, and all still count
    coarse = p2_ocr.fit_counted(rows, {"m": 3}, most_rows=60)["m"]
    assert len(coarse.cuts[0]) < len(whole.cuts[0]) and ((coarse.probability(x) > 0.5) == (y > 0.5)).mean() > 0.7
    assert coarse.base == pytest.approx(whole.base)
    assert len(p2_ocr.fit_counted(rows.limit(0), {"m": 3})["m"].trees) == 0


def test_texts_are_read_once(made):
    pages, lexicon = made
    reads = pages.sparkSession.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        reads.add(1)
        return text

    pages = pages.withColumn("text", seen("text"))
    pages.filter("text is not null").select("page_id", "lccn", "text").collect()
    once = reads.value
    assert p2_ocr.page_items(pages, lexicon).count() > 0 and reads.value == 2 * once >= 2 * pages.count()


def _items_of_text(models, text, name):
    lines = p2_ocr._BREAK.split(text)
    kinds = models.furniture(lines, name)
    out = {(kind, line.strip()) for kind, line in zip(kinds, lines) if kind}
    bodies, wholes = ["" if kind else line for kind, line in zip(kinds, lines)], []
    for i, (j, first, second, own) in models.divided(lines, kinds).items():
        wholes.append(p2_ocr.bare(f"{first}-{second}" if own else first + second))
        bodies[i] = p2_ocr._DIVIDED.sub(" ", bodies[i])
        bodies[j] = p2_ocr._BEGINS.sub(" ", bodies[j], count=1)
    odd, known = models.odd_words(bodies + wholes)
    return out | {("divided", w) for w in wholes} | {("odd", w) for w in odd}, known


def test_items_are_those_of_the_whole_text(tables):
    words = {r.word.lower(): r.is_common for r in tables[1].collect()}
    none = Boosted(np.zeros((0, 1)), np.zeros(0))
    models = p2_ocr.Lines(words, ("HERALD",), none, none, none).ready()
    # whatever the models say
    models._sure = lambda model, row: sum(map(ord, repr((model, *map(float, row))))) % 3 > 0
    rng = random.Random(4)
    said = [w for w in sorted(words) if len(w) > 4][:40]
    parts = [*said, *(ocr_words.corrupt(w, rng) for w in said), *(w[:3] + s for w in said[:9] for s in ("-", "¬", " -", "—", "  =")), *(w[3:] for w in said[:9])]
    parts += ["THE OAKHAM HERALD", "TUESDAY, APRIL 3, 1908.", "PAGE 7", "12", "vii", "XIV", "1886.", "1886", "١٩٠٨", "- 3 -", "“", "(", "-", "-\x0b", "\u00a0", "a", "A", "won't-", "“har-", "x—har-", "vest.”", "'", "—"]
    texts = []
    for _ in range(4000):
        lines = ["".join(f"{rng.choice(parts)}{rng.choice([' ', '  ', ''])}" for _ in range(rng.choice([0, 1, 1, 1, 2, 3, 6]))) for _ in range(rng.randint(1, 7))]
        texts.append("".join(f"{line}{rng.choice(['\n', '\n', '\r\n', '\r'])}" for line in lines))
    counts = p2_ocr.LineCounts(set(words), models.tokens)
    for text in texts:
        counts.add(None, text)
    kinds = set()
    for text, page in zip(texts, counts.pages()):
        want = _items_of_text(models, text, "OAKHAMHERALD")
        assert models.items(page, "OAKHAMHERALD") == want, text
        kinds |= {kind for kind, _ in want[0]}
    assert kinds == {"header", "page_number", "divided", "odd"}
