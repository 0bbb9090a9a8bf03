import html
import random
import re
import time

from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from corpuslab.functions import text as X
from corpuslab.functions.stopwords import ENGLISH_STOP_WORDS, STOP_WORDS
from corpuslab.operators import cleaning
from corpuslab.operators.features import token_columns

TEXTS = [
    "Plain words, with punctuation! And more of it.",
    "<p>Tagged <b>bold</b> text</p> with 5 < 6 and 7 > 2 signs",
    "  leading and trailing   spaces\t\ttabs\nand\x0bvertical ones  ",
    "accents iechä-1 split çwordsé everywhere naïve",
    "!!! ??? ... ### $$$ %%%",
    "hyphen-ated --double-- -edge- words here now",
    "ALL CAPS TEXT WITH Mixed Case Words 123",
    "emoji 😀 between words and 漢字 too ok yes",
]


def chain(text):
    """The five steps one after another."""
    step = re.sub(r"<[^>]+>", " ", text.lower())
    step = re.sub(r"[^a-z0-9\t\n\x0b\f\r -]", " ", step)
    return re.sub(r"[\t\n\x0b\f\r ]+", " ", step).strip(" ")


def test_clean_text_equals_the_chain(spark):
    df = spark.createDataFrame(enumerate(TEXTS), "doc_id int, text string")
    got = {r.doc_id: r for r in cleaning.clean_text(df).collect()}
    for i, text in enumerate(TEXTS):
        want = chain(text)
        words = len(want.split(" "))
        if 5 <= words <= 2000:
            assert got[i].text_clean == want
            assert (got[i].text_length, got[i].word_count) == (len(want), words)
        else:
            assert i not in got
    steps = df.select("doc_id", X.collapse_spaces(X.keep_allowed(X.strip_markup(F.lower("text")))).alias("c"))
    assert {r.doc_id: r.c for r in steps.collect()} == {i: chain(x) for i, x in enumerate(TEXTS)}


def test_length_and_word_limits(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, "short text"),  # ten characters
        (4, "a b c d e f"),
        (5, "one two three four"),
        (6, "one two three four five"),
        (7, " ".join(["w"] * 2000)),
        (8, " ".join(["w"] * 2001)),
        (9, "............................"),
    ]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    assert {r.doc_id for r in cleaning.clean_text(df).collect()} == {4, 6, 7}
    assert {r.doc_id for r in df.filter(X.has_text(F.col("text"))).collect()} == {4, 5, 6, 7, 8, 9}
    empty = df.filter("doc_id = 2").select(X.word_count(F.col("text")).alias("n"))
    assert empty.first().n == 1


def test_stop_words_are_the_default_list(spark):
    assert sorted(ENGLISH_STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))
    assert len(STOP_WORDS) == 181 + 14


def test_tokens_equal_the_ml_transformers(spark):
    texts = TEXTS + ["", " ", "one", "the a", " x  y ", "the patient used metformin", "tail  "]
    df = spark.createDataFrame(enumerate(texts), "doc_id int, text_clean string")
    ours = {r.doc_id: r for r in token_columns(df).collect()}
    stage = Tokenizer(inputCol="text_clean", outputCol="w").transform(df)
    stage = StopWordsRemover(inputCol="w", outputCol="f", stopWords=STOP_WORDS).transform(stage)
    stage = NGram(n=2, inputCol="f", outputCol="b").transform(stage)
    for row in stage.collect():
        mine = ours[row.doc_id]
        assert (mine.words, mine.filtered_words, mine.bigrams) == (row.w, row.f, row.b), texts[row.doc_id]


XML = """<Set><PubmedArticle><PMID Version="1">123</PMID><AbstractText Label="A">First part of a long abstract,
over two lines</AbstractText><x/><AbstractText>and a <i>second</i> part of it.</AbstractText></PubmedArticle>
<PubmedArticle><AbstractText>No identifier here but the text is certainly long enough to stay.</AbstractText></PubmedArticle>
<PubmedArticle><PMID>9</PMID><AbstractText>Too short.</AbstractText></PubmedArticle><PubmedArticle><PMID>8</PMID></PubmedArticle></Set>"""


def test_abstracts_from_a_dump(spark):
    got = cleaning.abstracts(spark.createDataFrame([(XML,), ("no records",)], "xml string")).collect()
    assert sorted((r.pmid, r.text) for r in got) == [
        ("pmid_123", "First part of a long abstract,\nover two lines and a second part of it."),
        ("pmid_unknown", "No identifier here but the text is certainly long enough to stay."),
    ]


def mark(text, entities):
    """One alternation over all labels, the longest text first."""
    label = {e.lower(): g for g, e in sorted(entities, reverse=True)}
    if not label:
        return html.escape(text, quote=False)
    choice = "|".join(re.escape(e) for e in sorted(label, key=lambda e: (-len(e), e)))
    parts, last = [], 0
    for m in re.finditer(choice, text, re.I):
        g = label[m.group().lower()]
        parts += [html.escape(text[last : m.start()], quote=False)]
        parts += [f'<span class="entity entity-{g}" title="{g}">{html.escape(m.group(), quote=False)}</span>']
        last = m.end()
    return "".join(parts) + html.escape(text[last:], quote=False)


def test_annotate_text(spark):
    docs = [
        ("1", "Metformin and metformin-xr for type 2 diabetes & more", [("Chemical", "metformin"), ("Chemical", "Metformin-XR"), ("Disease", "Diabetes")]),
        ("2", "a < b (c.d) [x] \\ $1 entity span class", [("Chemical", "(c.d)"), ("Disease", "span"), ("Chemical", "entity"), ("Disease", "$1")]),
        ("3", "no entity here", []),
        ("4", "aspirin in aspirin induced asthma", [("Disease", "aspirin induced asthma"), ("Chemical", "aspirin")]),
    ]
    frame = spark.createDataFrame([(d, x) for d, x, _ in docs], "doc_id string, text string")
    rows = [(d, label, e) for d, _, es in docs for label, e in es]
    entities = spark.createDataFrame(rows, "doc_id string, label string, text string")
    got = {r.doc_id: r.annotated for r in cleaning.annotate_text(frame, entities).collect()}
    assert got == {d: mark(x, es) for d, x, es in docs}


def test_annotation_wins_by_length_and_confidence(spark):
    docs = [
        ("1", "acid reflux and ACID <b> \ue000x\ue001 amp;", [("Chemical", "acid", 0.9), ("Disease", "Acid Reflux", 0.87)]),
        ("2", "cold cold", [("Disease", "cold", 0.86), ("Chemical", "Cold", 0.95), ("Disease", "amp", 0.9)]),
    ]
    frame = spark.createDataFrame([(d, x) for d, x, _ in docs], "doc_id string, text string")
    entities = spark.createDataFrame(
        [(d, *e) for d, _, es in docs for e in es], "doc_id string, label string, text string, confidence double"
    )
    got = {r.doc_id: r.annotated for r in cleaning.annotate_text(frame, entities).collect()}

    def tag(label, share, text):
        return f'<span class="entity entity-{label}" title="{label}: {share}% confidence">{text}</span>'

    reflux, acid = tag("Disease", "87.0", "acid reflux"), tag("Chemical", "90.0", "ACID")
    assert got["1"] == f"{reflux} and {acid} &lt;b&gt; \ue000x\ue001 amp;"
    assert got["2"] == " ".join([tag("Chemical", "95.0", "cold")] * 2)


def test_request_id(spark):
    df = spark.createDataFrame([(1, "given"), (2, None)], "k int, r string")
    first = [r.x for r in df.select(cleaning.request_id(F.col("r"), F.col("k")).alias("x")).collect()]
    again = [r.x for r in df.select(cleaning.request_id(F.col("r"), F.col("k")).alias("x")).collect()]
    assert first == again and first[0] == "given" and len(first[1]) == 8
    assert len(df.select(cleaning.request_id(F.col("r")).alias("x")).collect()[1].x) == 8


def test_annotating_takes_one_pass(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcſsKkßΣσςİi.+é&<") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    docs, rows = [(i, " ".join(rng.choices(words, k=40))) for i in range(40)] + [(98, None), (99, "a < b")], []
    for i in range(40):
        for w in rng.sample(words, 12):
            rows.append((i, rng.choice(["Chemical", "Disease", None]), w.upper() if i % 3 else w, rng.choice([0.875, 0.9123, None])))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    entities = spark.createDataFrame([*rows, (1, "Disease", "", 0.9), (1, "Disease", None, 0.9)], "doc_id long, label string, text string, confidence double")
    for given in (entities, entities.drop("confidence")):
        fields = [c for c in given.columns if c != "doc_id"]
        found = given.groupBy("doc_id").agg(F.collect_set(F.struct(*fields)).alias("found"))
        old = cleaning.annotate(F.col("text"), F.col("found"), "confidence" in fields)
        want = {r[0]: r[1] for r in frame.join(found, "doc_id", "left").select("doc_id", old).collect()}
        assert {r.doc_id: r.annotated for r in cleaning.annotate_text(frame, given).collect()} == want


def test_annotating_many_entities_grows_with_the_text():
    words = [f"w{i:05d}" for i in range(30_000)]
    text = " ".join(words)
    begin = time.perf_counter()
    assert cleaning.wrapped(text, dict.fromkeys(words, "<b>")).count("<b>") == len(words)
    assert time.perf_counter() - begin < 10
