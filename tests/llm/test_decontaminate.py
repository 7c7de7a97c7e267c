"""Slots of every item of a class and of every alignment; names of several words and at sentence starts."""

from panelcast.llm import decontaminate

SCHEMA = ["doc_id long, text string", "item_id long, text string"]


def found(spark, texts, items):
    frames = [spark.createDataFrame(list(enumerate(rows)), schema) for rows, schema in zip((texts, items), SCHEMA)]
    return {(r.doc_id, r.item_id): r for r in decontaminate.find_contamination(*frames).collect()}


def test_every_item_and_alignment_is_judged(spark):
    items = ["How much is 2 plus 2 when you add 5 more", "How much is 3 plus 7 when you add 5 more"]
    pairs = "so how much is {} plus {} when you add {} more and"
    other = "he asked how much is 4 plus 4 when 8 people add 4 more to it"
    texts = ["Tell me: " + items[1], pairs.format(4, 6, 9), pairs.format(4, 4, 4)]
    got = found(spark, texts + [other], items)
    assert got[0, 0].kind == "exact" and got[0, 0].consistency == 1 and got[0, 0]["items"] == 2
    assert {d for d, _ in got} == {0, 1, 2}
    # the earlier match breaks the only item's slots, the later one is a copy
    assert found(spark, [pairs.format(3, 7, 9) + " " + items[0]], items[:1])[0, 0].kind == "exact"
    assert found(spark, [pairs.format(3, 7, 9)], items[:1]) == {}


def test_names_of_several_words_and_at_sentence_starts(spark):
    item = "The bus goes from Paris to the sea in 3 hours. Anna takes it back each week. How long is Anna on the bus each year?"
    texts = [item.replace("Paris", "New York"), item.replace("Anna", "Peter"), item.replace("Anna", "Mary Ann"), "we know the bus " + item[8:], item.upper(), item.lower()]
    got = found(spark, texts, [item])
    assert {d for d, _ in got} == set(range(6))
    assert all(r.containment == 1 for (d, _), r in got.items() if d not in (3,))
    assert [got[d, 0].kind for d in range(6)] == ["reworded"] * 3 + ["exact"] * 3
    codes, starts, ends = decontaminate.tokens("we saw New York, Anna and Jean-Luc Picard. Paris is")
    text = "we saw New York, Anna and Jean-Luc Picard. Paris is"
    assert [text[a:b] for c, a, b in zip(codes, starts, ends) if c == decontaminate.NAME] == ["New York", "Anna", "Jean-Luc Picard"]


def kinds_of(text, names=True):
    codes, starts, ends = decontaminate.tokens(text, names)
    return [(text[a:b], decontaminate.SLOT_NAMES[int(c)]) for c, a, b in zip(codes, starts, ends) if int(c) in decontaminate.SLOT_NAMES]


def test_number_words_and_signs():
    number, unit = "number", "unit"
    text = "He paid $120, then 5% of two hundred and twenty-five euros, one two three. Forty-two of 3 million; ten hundred, and five"
    assert kinds_of(text) == [
        ("120", number), ("$", unit), ("5", number), ("%", unit), ("two hundred and twenty-five", number), ("euros", unit), ("one", number), ("two", number),
        ("three", number), ("Forty-two", number), ("3 million", number), ("ten hundred", number), ("five", number),
    ]
    assert kinds_of(text.lower(), False) == [(a.lower(), b) for a, b in kinds_of(text)]
    assert kinds_of("$ 5 %") == [("5", number), ("%", unit)] and kinds_of("$") == kinds_of("") == kinds_of("and hundred-fold $x")[1:] == []
    assert kinds_of("$5 €6 7 $8%") == [("5", number), ("$", unit), ("6", number), ("€", unit), ("7", number), ("8", number), ("$", unit), ("%", unit)]


def test_questions_with_numbers_in_words_and_signs(spark):
    items = [
        "A train leaves the town at 9 and drives 120 km to the sea in 2 hours. How fast does it drive on average?",
        "There are twelve apples in the old basket and you take away five of them, so how many apples do you have?",
        "How much is 2 plus 2 when you add 5 more to it and share it?",
    ]
    texts = [
        items[0].replace("120 km", "$120"), items[0].replace("at 9", "at nine"), items[1].replace("twelve", "15").replace("five", "7"),
        items[1].replace("twelve", "two hundred and six").replace("five", "thirty-one").lower(), "so " + items[1].upper(), items[2].replace("2", "six"),
        items[2].replace("2 plus 2", "six plus eight"), "a clean text of one or two words about nine apples and a train at ten",
    ]
    got = found(spark, texts, items)
    assert set(got) == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 1), (5, 2)}
    assert all(r.containment == 1 for r in got.values()) and got[4, 1].kind == "exact" and got[3, 1].kind == "reworded"
