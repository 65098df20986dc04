import pytest

from quernwork.llm import p1_pairs

MESSAGE = "conv_id bigint, turn int, role string, content string, dataset string, logged_at string, defect string"
PROSE = {
    "en": "The people of the town were certain that the harvest would be good and that the road was not to be mended. ",
    "fr": "Les habitants de la ville pensaient que la récolte serait bonne et que le chemin ne serait pas refait. ",
    "de": "Die Leute der Stadt glaubten, daß die Ernte gut werde und daß die Straße nicht erneuert werden solle. ",
    "es": "Los vecinos de la ciudad pensaban que la cosecha sería buena y que el camino no se haría otra vez. ",
    "it": "Gli abitanti della città pensavano che la raccolta sarebbe buona e che la strada non sarebbe rifatta. ",
}


def documents(spark):
    rows = [(i, code.upper() if i % 2 else code, PROSE[code] * 3 + "\n\n" + PROSE[code] * 2) for i, code in enumerate(list(PROSE) * 4)]
    return spark.createDataFrame(rows, "doc_id bigint, lang string, text string")


def defects(spark, turns):
    rows = []
    for k, (prompt, answer) in enumerate(turns):
        rows += [(k, 1, " Human", prompt, "d", "1", "z"), (k, 2, "BOT", answer, None, "1", "z"), (k, 2, "BOT", answer, None, "2", "z")]
    got = p1_pairs.judged_pairs(spark.createDataFrame(rows, MESSAGE), documents(spark)).collect()
    assert len(got) == len(turns)
    return [r.defect for r in sorted(got)]


ASK = "What is known of the harvest at Oakham, and was it good?"


def test_each_defect(spark):
    turns = [
        (ASK, None), (ASK, " ​\n"), (ASK, "n/a"), (ASK, "<p></p>"), (ASK, "[no answer]"),
        (ASK, "I am sorry, but I cannot help with that. Kindly ask me something else."),
        (ASK, "Prefiero no responder a esta pregunta."),
        (ASK, ASK.upper()), (ASK, "You ask: What is known of the harvest at Oakham, and was good?"),
        (ASK, PROSE["en"] + "The people of the town were"), (ASK, "There were three of these: 1. a mill; 2. a barn; 3."),
        (ASK, PROSE["en"].strip() + " It was told by the Rev."), (ASK, "In short:\n- the mill, first.\n-"),
        (ASK, PROSE["fr"].strip()), (ASK, f"{ASK}\n{ASK}"), (ASK, "-- intentionally left blank --"),
        (ASK, PROSE["en"].strip()), ("In one word, what place?", "Oakham"), ("Name some towns.", "- Oakham\n- Dunley\n- Marport"),
        ("Put this into French: “the harvest was good and the people were certain of it”", PROSE["fr"].strip()),
        (ASK, "I must decline to praise it, but here is the truth. " + PROSE["en"].strip()),
        (ASK, ASK + " " + PROSE["en"].strip()), (ASK, "As they say, “" + PROSE["de"].strip() + "” and so the people were certain of the road."),
        (None, PROSE["en"].strip()),
    ]
    want = ["empty"] * 5 + ["refusal"] * 2 + ["copied_question"] * 2 + ["truncated"] * 4 + ["other_language", "copied_question", "empty"] + [None] * 8
    assert defects(spark, turns) == want


def test_only_the_next_turn_is_a_pair(spark):
    rows = [(1, 0, "user", ASK, "d", "1", "z"), (1, 2, "assistant", None, "d", "1", "z"), (2, 0, "assistant", "", "d", "1", "z")]
    assert p1_pairs.judged_pairs(spark.createDataFrame(rows, MESSAGE), documents(spark)).count() == 0


@pytest.mark.parametrize("text", ["", "x", "é" * 20000])
def test_models_take_any_text(text):
    model, ends = p1_pairs.LanguageModel([("en", PROSE["en"])]), p1_pairs.EndModel([PROSE["en"] * 3])
    assert p1_pairs.defect_of(text, text, model, ends, p1_pairs.RefusalModel([])) in (None, "empty", "truncated", "copied_question")


def test_models_count_every_document_and_answer(spark):
    texts = [(i, "en", f"{PROSE['en']}It was the {'abcdefghij'[i % 10] * 3}{'klmnopqrst'[i // 10 % 10] * 3} of them") for i in range(400)]
    texts += [(900, "fr", PROSE["fr"] * 700), (901, "fr", PROSE["fr"]), (902, "FR", "Le blé."), (903, None, PROSE["it"]), (904, "en", None)]
    said = [PROSE["en"] + f"No {i}." for i in range(50)] + ["I must decline to answer. " * 4, PROSE["de"] * 700, "I cannot help"]
    rows = [(k, 2, "BOT", answer, None, "1", "z") for k, answer in enumerate(said)]
    documents = spark.createDataFrame(texts, "doc_id bigint, lang string, text string")
    language, ends, refusals = p1_pairs.fitted_models(spark.createDataFrame(rows, MESSAGE), documents)
    all_ends = p1_pairs.EndModel([t for _, _, t in texts if t], said)
    assert (language.log == p1_pairs.LanguageModel([(c.lower(), t) for _, c, t in texts if c and t]).log).all()
    assert refusals.weight == p1_pairs.RefusalModel(said).weight and ends.weight == all_ends.weight
    assert all(ends.probability(a.strip()) == all_ends.probability(a.strip()) for a in said)


def test_counts_of_ends_are_those_of_every_place():
    texts = ["", "Short.", PROSE["en"] + "\n\n" + PROSE["fr"], "日本語と😀" * 300 + "\0 end", "".join(map(chr, range(0x100, 0x400)))]
    want = {}
    for words in [" ".join(p.split()) for t in texts for p in t.split("\n\n")]:
        for at in [*range(4, len(words) - 1), len(words)] if len(words) >= 40 else []:
            want.setdefault(words[at - 4 : at], [0, 0])[at < len(words)] += 1
    assert {g: [e, i] for g, e, i in p1_pairs.end_counts(texts)} == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], MESSAGE)
    assert p1_pairs.judged_pairs(none, documents(spark).limit(0)).count() == 0
