from quernwork.llm import p3_quality

WORDS = [(w, w in ("the", "of", "and", "was", "in", "to", "that", "were")) for w in (
    "the of and was in to that were people town harvest road mended certain river house night morning people garden "
    "letter written carried window evening captain village market winter summer"
).split()]
RECORD = "table_name string, record_id string, text string, kind string, n_words int"

PROSE = "The people of the town were certain that the harvest was\nin the house, and the road to the village was mended in\nthe winter. "
VERSE = "The river in the morning,\nThe garden in the night,\nAnd to the town was carried\nThe letter to the light."
LIST = "\n".join(f"{i}) Albert Harmen, Oakham" for i in range(1, 15))
TABLE = "\n".join(f"Oakham   {i}.25   {i * 3}.10   {i * 7}" for i in range(1, 15))
JUNK = "\n".join(["zqxw jkqz xxqz wvkj qqzx", "rrrrrr lllll ,,,,, iiii tttt"] * 8)


def judged(spark, texts):
    rows = [("t", str(i), t, "own", 3) for i, t in enumerate(texts)]
    frame = p3_quality.text_statistics(spark.createDataFrame(rows, RECORD), spark.createDataFrame(WORDS, "word string, is_common boolean"))
    return {int(r.record_id): r for r in frame.collect()}


def test_kinds(spark):
    texts = [PROSE * 4, VERSE, LIST, TABLE, JUNK, PROSE.upper() * 3, PROSE * 6 + "\n" + TABLE[:60], None, "", " \n "]
    got = judged(spark, texts)
    assert [got[i].kind for i in range(7)] == ["prose", "prose", "list", "table", "junk", "prose", "prose"]
    assert [got[i].kind for i in (7, 8, 9)] == [None] * 3
    assert got[7].n_words is None and got[8].n_words == 0


def test_statistics(spark):
    row = judged(spark, ["The road.\nthe town, 12"])[0]
    assert (row.n_words, row.n_lines, row.n_chars) == (4, 2, 22)
    assert row.common_word_share == 0.5 and row.end_punctuation_share == 0.5
    assert row.mean_word_length == 14 / 4 and row.digit_ratio == 2 / 18


def test_long_and_repeated_records(spark):
    rows = [("t", "1", TABLE, "k", 0)] * 3 + [("t", "2", "x" * 100_000, "k", 0)]
    found = p3_quality.not_prose(spark.createDataFrame(rows, RECORD), spark.createDataFrame(WORDS, "word string, is_common boolean"))
    assert [(r.record_id, r.kind) for r in found.filter("record_id = '1'").collect()] == [("1", "table")]


def test_empty_tables(spark):
    none = spark.createDataFrame([], RECORD)
    assert p3_quality.not_prose(none, spark.createDataFrame([], "word string, is_common boolean")).count() == 0


def test_layout_settles_the_kind(spark):
    names = ["River house", "Garden market", "Captain", "Harvest road", "Village", "Winter letter", "Window", "Morning town"]
    # two columns of words: only where the delimiters stand tells them from a text with wide gaps
    columns = "\n".join(f"{a:<18}of the {b.lower()} and people" for a, b in zip(names, names[::-1]))
    ragged = "\n".join(f"{a:<{12 + 5 * (i % 4)}}of the {b.lower()} and people" for i, (a, b) in enumerate(zip(names, names[::-1])))
    # entries of no one form: the period of the indents makes them a list, without it they are none
    bodies = ["River house, market", "garden captain", "Village, winter, letter.", "town window;", "Harvest, road, house, river", "market garden."]
    entries = [f"{'    ' * (i % 2)}{bodies[i % 6]}" for i in range(12)]
    flat = [e.strip() for e in entries[:5]]
    got = judged(spark, [columns, ragged, "\n".join(entries), "\n".join(flat)])
    assert [got[i].kind for i in range(4)] == ["table", "prose", "list", "prose"]


def test_lists_of_titles_and_signs_without_language():
    judge = p3_quality.Judge(dict(WORDS))
    judge.letters.least = -9.0
    titles = "Tales of Oakham; by Ann Lee\nSketches of Kirley; by Giles Ashson\nLetters of Paxport; by Hugh Ridge\nAnnals of Yarness; by Dr. Well"
    assert judge.record(titles)["kind"] == "list"
    assert judge.record("{t [|1,^ *¶■. .I->-.,{;'_l\n¶i~l|j{l:I[.}_{.=[{t> '•■,;i1]\\■\n~■•}< .•i1I¶[-l|>\\_l-")["kind"] == "junk"
    verse = "And quickly the town was lost\nAnd wisely the harvest was found\nAnd slowly the town was won\nAnd sadly the harvest was gone"
    assert judge.record(verse)["kind"] == "prose"


def test_layout_takes_part_in_the_decision(monkeypatch):
    judge = p3_quality.Judge({"the": True, "of": True})
    rows = "wool of the north     dear     none\nrope of the south     low      some\ntin of the east       fair     much"
    assert judge.record(rows)["kind"] == "table"
    monkeypatch.setattr(p3_quality, "_placed", lambda a, b: 0.0)
    assert judge.record(rows)["kind"] != "table"
