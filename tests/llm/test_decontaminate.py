import random

from patchlode.llm.decontaminate import find_contamination

QUESTION = "In spring Anna buys 12 apples for 3 dollars each and then Anna gives 12 of them to the old man near the river, how many are left"


def test_copies_and_other_parameters(spark):
    rng = random.Random(1)
    noise = lambda n: " ".join(rng.choice("abcdefgh") + str.lower(rng.choice("klmnop")) * rng.randrange(1, 9) for _ in range(n))
    items = [(1, QUESTION), (2, "short one here"), (3, None), (4, ""), (5, noise(30)), (6, "42 17 99")]
    changed = QUESTION.replace("Anna", "Boris").replace("12", "57").replace("dollars", "euros")
    torn = QUESTION.replace("Anna", "Boris", 1).replace("and then Anna", "and then Clara")
    docs = [
        (10, f"{noise(40)}. {QUESTION}. {noise(40)}"),
        (11, f"{noise(40)} Boris said: {changed} {noise(10)}"),
        (12, torn + " " + noise(20)),
        (13, noise(200)), (14, None), (15, ""), (16, "A SHORT one, here!"), (17, items[4][1].upper()),
        (18, " ".join(items[4][1].split()[:8])), (19, " ".join(items[4][1].split()[3:25])), (20, "42 17 99"), (21, changed), (21, changed), (None, QUESTION),
    ]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, item_id string, h int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in find_contamination(frame, bench).collect()}
    assert found == {(10, 1): False, (11, 1): True, (16, 2): False, (17, 5): False, (19, 5): False, (20, 6): False, (21, 1): True, (None, 1): False}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, QUESTION)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, QUESTION)], "item_id bigint, text string")
    assert find_contamination(docs.limit(0), bench).count() == 0
    assert find_contamination(docs, bench.limit(0)).count() == 0
    assert find_contamination(docs, bench).count() == 1


def test_slots_alone_and_capitals_at_the_beginning(spark):
    items = [(1, "12 + 30 = 42"), (2, "Who wrote the first novel"), (3, "Anna Boris Clara 5 km 7 kg"), (4, "99"), (5, "Compute 3 + 4 * 5"), (6, "What is Ohm")]
    docs = [
        (10, "as every child knows, 12 + 30 = 42, and no more"), (11, "Question: Who wrote the first novel"), (12, 'he asked "Who wrote the first novel" again'),
        (13, "Who wrote the first novel"), (14, "we know who wrote the first novel by now"), (15, "12 + 31 = 43"), (16, "anna boris clara 5 km 7 kg"),
        (17, "page 99 of 99"), (18, "Then compute 3 + 4 * 5 now"), (19, "Task: Compute 3 + 4 * 6"), (20, "We ask: What is Ohm here"), (21, "Who wrote"), (22, "30 12 42"),
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in find_contamination(frame, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert {(10, 1), (11, 2), (12, 2), (13, 2), (14, 2), (16, 3), (18, 5), (20, 6)} <= found
    assert not {d for d, _ in found} & {15, 17, 19, 21, 22}


def test_every_verbatim_item_is_found_in_long_texts(spark):
    """Brute force over words: items of any make-up, copied into long texts with any case in front, are all found."""
    rng = random.Random(7)
    words = ["alpha", "Beta", "gamma", "12", "7.5", "km", "Delta", "+", "=", "x1", "omega", "the"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(4, 40)))) for i in range(40)]
    filler = lambda n: " ".join(rng.choice("bcdfg") + rng.choice("aeiou") * rng.randrange(1, 6) + rng.choice("klmn") for _ in range(n))
    docs = [(i, f"{filler(rng.randrange(3000))} {rng.choice(['so', 'Answer:', 'then.', '(a)'])} {text} {filler(rng.randrange(30))}") for i, text in items]
    docs += [(100 + i, filler(4000)) for i in range(20)]
    found = {(r["doc_id"], r["item_id"]) for r in find_contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}

    def tokens(text):
        return [w for w in ("".join(c for c in t.lower() if c.isalnum() or c.isspace()) for t in text.split()) if w]

    long_enough = {i for i, text in items if len(tokens(text)) >= 3}
    assert {(i, i) for i in long_enough} <= found and not {d for d, _ in found if d >= 100}
