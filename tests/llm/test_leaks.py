import random

from pagemill.llm import leaks, leaks_queries

DOCS = "doc_id bigint, text string, item_id string, n_words int"
ITEMS = "item_id bigint, text string, answer string"

ITEM = "A party of 24 led by a bitter duelist finds a tin whistle beside the bitter iron toad, and Emeric must pass 24 tests."


def test_words_of():
    assert leaks.words_of("The “Old”\nSong, half-\ngiant’s! Ｏne​ two") == ["the", "old", "song", "halfgiants", "one", "two"]
    assert leaks.words_of("half-giant") == leaks.words_of("half-\n giant") == leaks.words_of("half­\ngiant") == ["halfgiant"]
    assert leaks.words_of("> a\n> b") == ["a", "b"] and leaks.words_of("") == []


def _found(spark, docs, items, least=12):
    got = leaks.runs(spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS), spark.createDataFrame([(*i, "") for i in items], ITEMS))
    return {(r.doc_id, r.item_id) for r in got.where(f"literal_words >= {least}").select("doc_id", "item_id").collect()}


def test_quotations(spark):
    words = ITEM.split()
    docs = [
        (1, "Before. " + ITEM.upper() + " After."),
        (2, " ".join(words[:12])),
        (3, " ".join(words[:11])),
        (4, "\n> ".join(" ".join(words[i : i + 4]) for i in range(0, len(words), 4))),
        (5, ITEM.replace("duelist", "due-\nlist").replace("a", "а")),
        (6, ITEM.replace("24", "31")),
        (7, None),
        (8, ""),
        (9, "filler " * 50_000 + ITEM),
        (1, "Before. " + ITEM.upper() + " After."),
    ]
    assert _found(spark, docs, [(1, ITEM), (1, ITEM), (2, None), (3, "too short"), (None, ITEM)]) == {(1, 1), (2, 1), (4, 1), (5, 1), (9, 1), (6, 1)}


def test_reparameterised(spark):
    docs = [(1, ITEM.replace("24", "7").replace("Emeric", "Thend")), (2, ITEM.replace("24", "7", 1))]
    runs = leaks.runs(spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS), spark.createDataFrame([(1, ITEM + " Now Thend rests.", "")], ITEMS))
    got = {(r.doc_id, r.changed, r.consistent) for r in runs.where("changed > 0").collect()}
    assert got == {(1, 3, True), (1, 1, True), (2, 1, False)}


def test_names_of_the_document_are_names(spark):
    item = "A party led by a bitter duelist finds a rose beside the iron toad, and Emeric must pass ten tests for the crown."
    docs = [(1, item.replace("Emeric", "Balduin")), (2, item.replace("Emeric", "Rose")), (3, item.replace("iron toad", "Iron Toad")), (4, item.replace("Emeric", "balduin")), (5, item.replace("iron toad", "Iron Toad").replace("Emeric", "Balduin"))]
    got = leaks.runs(spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS), spark.createDataFrame([(1, item, "")], ITEMS))
    n = len(item.split())
    # 5: a run ends where one side has a name and the other hasn't, and a new name goes beyond the first template
    assert {(r.doc_id, r.n_words, r.changed) for r in got.collect()} == {(1, n, 1), (1, 15, 0), (2, n, 1), (2, 15, 0), (3, n, 0), (5, 15, 0), (4, 15, 0)}


def test_short_reparameterised_runs_are_reported(spark, tmp_path):
    words = ITEM.split()[:14]
    spark.createDataFrame([(1, " ".join(words).replace("24", "7"), "x", 1)], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM, "")], ITEMS).write.parquet(f"{tmp_path}/eval_items.parquet")
    assert [tuple(r) for r in leaks_queries.p7_reparameterised(spark, str(tmp_path)).collect()] == [(1, 1, 14, 1, 1)]


def test_blocks_of_items_beside_one(spark):
    rng = random.Random(3)
    bag = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(bag, k=20))) for i in range(12)]
    docs = []
    for d in range(40):
        base = rng.choices(bag, k=40)
        i, n = rng.randrange(12), rng.choice([8, 11, 12, 15])
        base[10:10] = items[i][1].split()[2 : 2 + n]
        docs.append((d, " ".join(base)))
    want = {(d, i) for d, t in docs for i, x in items if any(" ".join(x.split()[k : k + 12]) in t for k in range(9))}
    assert _found(spark, docs, items) == want != set()
    few = leaks.runs(spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS), spark.createDataFrame([(*i, "") for i in items], ITEMS), block_words=30)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, leaks.runs(spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS), spark.createDataFrame([(*i, "") for i in items], ITEMS), block_words=10_000).collect()))
    assert {(r.doc_id, r.item_id) for r in few.where("literal_words >= 12").collect()} == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert leaks.runs(none, spark.createDataFrame([(1, ITEM, "")], ITEMS)).count() == 0
    assert leaks.runs(spark.createDataFrame([(1, ITEM, None, None)], DOCS), spark.createDataFrame([], ITEMS)).count() == 0


def _planted(text, rng):
    """A copy with other numbers, names and units."""
    names = {n: rng.choice(["Zorina", "Karim", "Tolan"]) + n[-2:].lower() for n in ("Alice", "Bob", "Mireille")}
    left = {"number": ["fifteen", "two hundred", "forty-six", str(rng.randint(40, 999))], "unit": ["liters", "ounces", "kg"]}
    rng.shuffle(left["number"])
    rng.shuffle(left["unit"])
    words = []
    for w in text.split():
        bare = w.strip(".,?")
        if bare not in names:
            names[bare] = left["number"].pop() if bare.isdigit() or bare in ("three", "twelve") else left["unit"].pop() if bare in ("kilometers", "apples") else bare
        words.append(w.replace(bare, names[bare]))
    return " ".join(words)


PROBLEMS = [
    "Alice walks 3 kilometers to see Bob, and then Alice gives Bob 12 apples before the heavy rain begins. How much is left?",
    "Every morning Mireille carries 7 kilometers of rope over the old bridge while Bob counts three coins twice for the guard.",
    "Before the siege ends, twelve guards and Mireille walk 40 kilometers along the river and rest where Alice once had lived.",
]


def test_recall_on_planted_copies():
    rng = random.Random(5)
    index = leaks.Index(list(enumerate(PROBLEMS)), 12)
    hit = n = 0
    for _ in range(40):
        for i, text in enumerate(PROBLEMS):
            doc = f"Some text that leads to it. {_planted(text, rng)} And the text goes on for long."
            hit += any(r[0] == i and r[6] and r[7] for _, r in leaks.find_runs(index, leaks.Words(), [doc]))
            n += 1
    assert hit >= 0.9 * n
    # equal values must stay equal, and different ones different
    two = PROBLEMS[0].replace("Bob,", "Karim,").replace("Bob 12", "Zorina 12")
    one = PROBLEMS[0].replace("Bob", "Alice")
    for text in (two, one):
        assert not [r for _, r in leaks.find_runs(index, leaks.Words(), [text]) if r[6] and r[7]]


def test_numbers_alone_tell_nothing_but_quotations_do():
    import time

    numbers = [str(k * 7 % 1000) for k in range(4000)]
    index = leaks.Index([(1, " ".join(numbers[100:500])), (2, "0 " * 400)], 12)
    began = time.process_time()
    found = list(leaks.find_runs(index, leaks.Words(), [" ".join(str(k * 13 % 997) for k in range(4000)), " ".join(numbers), "0 " * 4000]))
    assert time.process_time() - began < 0.5
    assert {(k, r[0], r[4]) for k, r in found} >= {(1, 1, 400), (2, 2, 400)} and all(k for k, _ in found)


def test_ids_keep_their_type(spark):
    items = spark.createDataFrame([("i-1", ITEM, "")], "item_id string, text string, answer string")
    docs = spark.createDataFrame([("d-1", ITEM, "x", 1)], "doc_id string, text string, item_id string, n_words int")
    assert [(r.doc_id, r.item_id, r.literal_words) for r in leaks.runs(docs, items).collect()] == [("d-1", "i-1", len(ITEM.split()))]
