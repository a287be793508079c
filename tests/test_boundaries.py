import math

from sifter.operators import boundaries as B

PEOPLE = "Smith Jones Weber Martin Novak Costa Lind Moreau".split()
VERBS = "walked talked painted travelled waited answered".split()


def corpus():
    out = []
    for i in range(120):
        a, b, v = PEOPLE[i % 8], PEOPLE[(i * 3 + 1) % 8], VERBS[i % 6]
        out.append(f"Yesterday Dr. {a} {v} with Prof. {b} about fig. {i % 9}. The answer was {VERBS[(i + 2) % 6]}. The late end came late.")
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")


def test_abbreviations_are_found_and_scores_follow_the_formula(spark):
    counts = B.word_counts(frame(spark, corpus()))
    rows = {r.word: r for r in B.abbreviations(counts).collect()}
    assert set(rows) >= {"dr", "prof", "fig"} and not set(rows) & {"late", "the", "smith"}
    n_all, k_all = counts.groupBy().sum("n", "k").first()
    p, r = k_all / n_all, rows["dr"]
    assert (r.n, r.k) == (120, 120)
    ratio = 2 * (120 * math.log(0.99) - 120 * math.log(p))
    assert math.isclose(r.score, ratio * math.exp(-2), rel_tol=1e-9)


def test_sentences_stay_whole_after_abbreviations_and_initials(spark, params):
    texts = ["Then Dr. Weber met J. Novak. The rest waited.", "See fig. 7 of it!  Who asked Prof. Lind? Nobody.",
             "He called the Dr. The answer came.", "He saw the Dr.\nNovak left.", "Ends with fig.", "", None, "   ", "no stop", "Ünser Dr. Österle kam. Gut."]
    got = {}
    for r in B.learned_sentences(frame(spark, texts), "id", params, train=frame(spark, corpus()).drop("id")).orderBy("id", "sent_no").collect():
        got.setdefault(r.id, []).append(r.sent)
    assert got == {
        0: ["Then Dr. Weber met J. Novak.", "The rest waited."],
        1: ["See fig. 7 of it!", "Who asked Prof. Lind?", "Nobody."],
        2: ["He called the Dr.", "The answer came."],  # a frequent starter ends the sentence
        3: ["He saw the Dr.", "Novak left."],  # so does a newline
        4: ["Ends with fig."], 8: ["no stop"], 9: ["Ünser Dr. Österle kam.", "Gut."]}


def test_no_stops_no_rows_and_a_very_long_text(spark, params):
    none = frame(spark, ["no stops here", "none at all"])
    assert B.abbreviations(B.word_counts(none)).count() == 0
    assert [r.sent for r in B.learned_sentences(none, "id", params).orderBy("id").collect()] == ["no stops here", "none at all"]
    assert B.learned_sentences(none.where("id < 0"), "id", params).count() == 0
    long = frame(spark, [" ".join(corpus() * 60)])  # about a megabyte
    sents = B.learned_sentences(long, "id", params)
    assert sents.count() == 3 * 120 * 60
    assert sents.where("sent rlike '(Dr|Prof|fig)[.]$'").count() == 0


def test_blanks_are_the_whitespace_of_the_splitter(spark):
    from pyspark.sql import functions as F

    from sifter.functions import text as T

    assert B.BLANKS == "".join(c for c in map(chr, range(0x110000)) if c.isspace())
    row = spark.createDataFrame([(c,) for c in B.BLANKS], "c string").agg(F.min(F.col("c").rlike(f"^[{T.WS}]$"))).first()
    assert row[0]


def test_words_are_counted_across_all_whitespace(spark):
    texts = ["a b\tc.  c.\n\nB, b　(c.)", " a\r\na ", "", None, "a.b. x1  "]
    got = {r.word: (r.n, r.k) for r in B.word_counts(frame(spark, texts)).collect()}
    assert got == {"a": (3, 0), "b": (3, 0), "c": (3, 3), "a.b": (1, 1)}


def test_documents_are_split_in_their_rows_and_long_lists_give_the_same(spark, params, monkeypatch):
    odd = ["  Dr. Weber came. \t He left.\r\n　The Dr. Novak? Yes. ", "x.  .  Dr.\tJ. Lind said (J. Lind). Prof. The end.",
           "\n\n", "Dr. ", "see (fig. 3). A. B. C. D.", "ends in J.\nDr.\n. The Dr.! No", "Dr. Weber came with Prof. Lind. e.g. Dr. X."]
    docs = frame(spark, [*odd, *corpus(), None, ""])
    found = B.learned_sentences(docs, "id", params)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan  # no text is shuffled
    rows = sorted(map(tuple, found.collect()))
    monkeypatch.setattr(B, "LIST_WORDS", 0)
    joined = B.learned_sentences(docs, "id", params)
    assert "Window" in joined._jdf.queryExecution().executedPlan().toString()
    assert rows == sorted(map(tuple, joined.collect())) and found.dtypes == joined.dtypes
    assert [s for i, _, s in rows if i == 0] == ["Dr. Weber came.", "He left.", "The Dr. Novak?", "Yes."]
