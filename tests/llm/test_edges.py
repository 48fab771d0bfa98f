"""Nulls, empty and very long texts, ties, repeated rows, empty tables, and extra columns with clashing names."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidewright.llm import byte_bpe, chat_format, language_id, licenses, media, near_dedup, packing, quality, queries, repeats, token_counts
from tidewright.llm.workspace import Workspace

CLASHES = ["n", "mark", "left", "doc", "tag", "t", "rows", "kept", "ids", "n_tokens", "sequence_id", "digest", "span", "k", "value", "piece", "v", "data", "words", "lines", "turns", "n_words", "dice"]
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def texts():
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(draw.choice(words) + draw.choice(["", "", ".", ",", "\n", "  "]) for _ in range(n))
    passage, long, copy = prose(160), prose(60_000), prose(200)
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "one two"), (6, "ONE two"), (7, copy), (8, copy), (9, copy + " tail"), (10, long), (11, long + " x"),
        (12, prose(50) + passage + prose(40)), (13, prose(30) + passage), (14, passage + passage), (15, "é  ß 漢字 \x1c\x1d 🙂🙂 \x85" * 40),
        (16, "<|endoftext|> a<|endoftext|>b <|startoftext|>  x"), (17, "a" * 5000), (18, "word " * 900), (19, "#*$%&|<>" * 30), (None, "no id at all"), (None, None), (7, copy),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts()], "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({c: F.lit(c) for c in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_packing(spark, docs, none):
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    work = Workspace(spark, "t")
    packed = packing.pack(packing.token_pieces(docs, vocabulary, with_ids=True), work)
    assert got(packed, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(brute.pieces(texts()), key=str)
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert fill.where("n > 2048 OR n != end").count() == 0
    assert packing.pack(packing.token_pieces(none, vocabulary), Workspace(spark, "t")).count() == 0
    with pytest.raises(ValueError, match="clash"):
        packing.pack(docs.withColumn("length", F.lit(1)), work)


def test_token_counts(docs, none):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    assert got(token_counts.count_tokens(docs, vocabulary), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(brute.token_counts(texts()), key=str)
    assert token_counts.count_tokens(none, vocabulary).count() == 0


def test_byte_bpe(docs, none):
    assert got(byte_bpe.round_trip_digests(docs, RANKS, PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(brute.byte_bpe(texts()), key=str)
    encoded = byte_bpe.encode(docs.where("doc_id = 15"), RANKS, PATTERN)
    back = byte_bpe.decode(encoded, RANKS, PATTERN).first()
    assert back.text == dict(texts())[15]
    row = encoded.first()
    assert row.ids == brute.coder().encode_ordinary(back.text) and row.offsets == sorted(set(row.offsets))
    assert byte_bpe.decode(encoded.select("doc_id", F.slice("ids", 1, 1).alias("ids")), RANKS, PATTERN).first().bytes == back.text.encode()[: row.offsets[1]]
    assert byte_bpe.round_trip_digests(none, RANKS, PATTERN).count() == 0


def test_random_strings_encode_like_tiktoken():
    own, reference, draw = byte_bpe.ByteBpe(RANKS, PATTERN), brute.coder(), random.Random(5)
    for _ in range(300):
        text = "".join(chr(draw.choice([draw.randint(1, 127), draw.randint(128, 0x2FF), draw.randint(0x370, 0xD7FF), draw.randint(0x10000, 0x1FFFF), 32, 10])) for _ in range(draw.randint(0, 60)))
        ((ids, decimal),) = own.encode([text])
        assert ids == reference.encode_ordinary(text) and decimal == ",".join(map(str, ids)) and own.decode(ids) == text.encode()


def test_media(spark, docs, none):
    index = media.store_media(docs, Workspace(spark, "t"))
    read = media.read_features(media.read_headers(index), 32)
    assert got(read, "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == sorted(((d, *brute.payload(t)) for d, t in texts()), key=str)
    assert media.store_media(none, Workspace(spark, "t")).count() == 0
    raw = bytes(range(256)) * 9
    assert media.from_png(media.to_png(raw)) == raw


def test_language(docs, none, spark):
    model = language_id.train(docs.withColumn("lang", F.when(F.col("doc_id") < 9, "aa").otherwise("bb")), F.col("doc_id") != 3)
    rows = {(r.doc_id, r.lang_pred) for r in language_id.predict(docs, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (19, "und")} <= rows and all(p in ("und", "aa", "bb") for _, p in rows)
    untaught = language_id.train(none, F.lit(True))
    assert {r.lang_pred for r in language_id.predict(docs, untaught).collect()} == {"und"}
    assert language_id.predict(none, model).count() == 0


def test_quality(docs, none):
    want = sorted(((d, *brute.quality(t)) for d, t in texts()), key=str)
    judged = quality.judge(docs)
    assert got(judged, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert quality.judge(none).count() == 0


def test_line_rules(spark):
    lines = {
        "The words of this line end as they should.": False, "Heading": False, "Short heading here": False, "these four words lack any": True,
        "home | news | sport | weather.": True, "Back to top": True, "We use a cookie to serve you.": True, "=== /// --- +++": True, "these*** are$$$ marks&&& all over.": True, "It costs $5 & more.": False,
    }
    frame = spark.createDataFrame([(x,) for x in lines], "x string").select("x", quality.line_fails(F.col("x")).alias("f"))
    assert {r.x: r.f for r in frame.collect()} == lines
    text = "\n".join(["A line of prose that goes on for long enough to be kept, as it ought to be."] * 1 + ["Another line of plain prose, no less long, that is kept as well.", "", "menu"])
    one = quality.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert one.kept and one.clean_text == text.removesuffix("\nmenu") and one.lost_chars == 4


def test_ordinary_texts_are_kept(spark):
    """Words that boilerplate uses stand in prose too, and sentences end in more marks than Latin ones."""
    bakers = "The bakery sells a cookie that people cross the town for.\nIts owner wrote a compiler from JavaScript to oven timers when she was young.\nNow she bakes, and the timers still run as they ought to."
    hindi = "यह एक छोटी सी कहानी है जो गाँव के बारे में है।\nवहाँ एक नदी बहती थी और लोग सुबह उसके पास आते थे।\nफिर सब अपने घर लौट जाते थे और दिन भर काम करते थे।"
    frame = spark.createDataFrame([(1, bakers, 7), (2, hindi, 8)], "doc_id long, text string, kept long")
    assert [(r.kept, r.lost_chars) for r in quality.judge(frame).orderBy("doc_id").collect()] == [(True, 0), (True, 0)]
    left = quality.clean(frame)
    assert left.columns == frame.columns and sorted(tuple(r) for r in left.collect()) == [(1, bakers, 7), (2, hindi, 8)]


THAI = "\n".join(["วันนี้ อากาศ ดี มาก เรา จึง ไป เดินเล่น ที่ สวน กับ เพื่อน หลาย คน", "เด็ก หลาย คน วิ่งเล่น อยู่ ใต้ ต้นไม้ ใหญ่ ริม น้ำ ใน ตอน เช้า"])
VERSE = "\n".join(["The morning walks along the bay", "and leaves its slippers in the sand", "a boat goes by with none to say", "what it has carried to the land", "The gulls are talking to the rain", "of summers that were never planned"])
COOKIES = "We use cookies to make this site work for you and to see how it is used, and by going on you say yes to our cookie policy, which you can read at any time, or change in the cookie settings below."
PROSE = "The river rose in the night and by dawn the lower field was a lake.\nNobody in the village had seen the like of it.\nThey moved the cows to the hill and waited for the water to go."


def test_unmarked_scripts_verse_and_long_boilerplate(spark):
    texts = {1: THAI, 2: VERSE, 3: f"{PROSE}\n{COOKIES}\n{PROSE.upper()}", 4: f"{COOKIES}\n{COOKIES.replace('We', 'They')}", 5: PROSE.replace("seen the like of it.", "seen the like of it"), 6: " ".join(["word"] * 4 + [f"w{k}" for k in range(30)])}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in quality.judge(frame).collect()}
    assert (got[1].lost_chars, got[2].lost_chars, got[1].kept, got[2].kept) == (0, 0, True, True)
    assert got[3].kept and got[3].clean_text == f"{PROSE}\n{PROSE.upper()}" and not got[4].kept
    assert got[5].clean_text == "\n".join(PROSE.split("\n")[::2]) and not got[6].kept


def test_licenses(docs, none, spark):
    assert licenses.scan_licenses(docs).count() == len(texts()) and licenses.scan_licenses(none).count() == 0
    frame = spark.createDataFrame([(1, "Some prose.\nReleased under the MIT license\nmore"), (2, "licensed under cc by 4.0"), (3, "mit license"), (4, None)], "doc_id long, text string")
    found = {r.doc_id: (r.license, r.n_license_lines, r.whole_license) for r in licenses.scan_licenses(frame).collect()}
    assert found == {1: ("MIT", 1, None), 2: ("CC-BY-4.0", 1, "CC-BY-4.0"), 3: (None, 0, None), 4: (None, 0, None)}


def test_anchor_words_cover_every_template():
    tests = licenses.templates()
    anchors = set(licenses.anchor_words(tests, licenses.LEAST_DICE))
    for t in tests:
        assert sum(not anchors & set(b.split()) for b in t.bigrams) < t.least_shared(licenses.LEAST_DICE)


def test_near_duplicates(spark, docs, none):
    known = [(d, t) for d, t in texts() if d is not None]
    want = brute.near(dict(known).items())
    found = near_dedup.near_duplicates(docs, Workspace(spark, "t"))
    assert got(found.where("doc_id IS NOT NULL"), "doc_id", "n_shingles", "component_id") == sorted(((d, *want[d]) for d, _ in known), key=str)
    assert got(found.where("doc_id IS NULL"), "component_id", "kept") == [(None, True)] * 2
    assert near_dedup.near_duplicates(none, Workspace(spark, "t")).count() == 0


def cluster(n, words, edits, draw):
    base = [draw.choice("abcdefghijklmnopqrstuvwxyz") + str(draw.randint(0, 10**6)) for _ in range(words)]
    for _ in range(n):
        own = list(base)
        for _ in range(edits):
            own[draw.randrange(words)] = f"e{draw.randint(0, 10**9)}"
        yield " ".join(own)


def test_near_duplicates_in_large_groups(spark):
    """Near copies of one text that are not all alike, unrelated texts around one passage, and chains."""
    draw = random.Random(11)
    passage = " ".join(f"p{k}" for k in range(60))
    made = [*cluster(150, 200, 3, draw), *cluster(120, 120, 2, draw)]
    made += [" ".join([passage, *(f"u{i}x{k}" for k in range(draw.choice([15, 40, 100])))]) for i in range(120)]
    chain = [f"c{k}" for k in range(300)]
    made += [" ".join(chain[12 * k : 12 * k + 150]) for k in range(10)]
    frame = list(enumerate(draw.sample(made, len(made))))
    found = near_dedup.near_duplicates(spark.createDataFrame(frame, "doc_id long, text string"), Workspace(spark, "t"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute.near(frame)


class Kept(Workspace):
    """A workspace whose tables stay, to be counted."""

    def drop(self, name=""):
        pass

    def drop_all_but(self, *names):
        pass

    def table(self, name):
        try:
            return self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException:
            return None


def form_pages(n, draw):
    """Pages of one form: twelve fields of three values each."""
    label = lambda field: " ".join(f"f{field}w{k}" for k in range(13))
    return [" ".join(f"{label(field)} v{draw.randrange(3)}" for field in range(12)) for _ in range(n)]


def linked_components(texts):
    """The least index that each text can reach by links of 0.75, by products of matrices."""
    sets = [near_dedup.shingle_set(t.encode()) for t in texts]
    names, place = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    holds = np.zeros((len(sets), len(names)), np.float32)
    holds[np.repeat(np.arange(len(sets)), sizes), place] = 1
    both = holds @ holds.T
    links = 100 * both >= 75 * (sizes[:, None] + sizes - both)
    least = np.arange(len(sets))
    while True:
        now = np.where(links, least, len(sets)).min(axis=1)
        now = now[now]
        if (now == least).all():
            return least
        least = now


def test_pages_of_one_form_make_work_in_line_with_rows(spark):
    """Four times the rows make at most 5.2 times the pairs and the comparisons inside lists."""
    work = {}
    for n in (1000, 4000):
        made = form_pages(n, random.Random(3))
        kept = Kept(spark, "form")
        frame = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
        found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame, kept).collect()}
        assert [found[k] for k in range(n)] == linked_components(made).tolist()
        names = ["pairs-0", "pairs-1", "first-pairs", *(f"neighbours-{turn}" for turn in range(40))]
        pairs = sum(t.count() for t in map(kept.table, names) if t)
        compared = 0
        if bits := kept.table("first-shingles-bits"):
            lists = bits.join(kept.table("first-mains"), "s").groupBy("s").agg(F.count("*").alias("n"), F.count_if(F.col("component") != F.col("main")).alias("outside"))
            compared = lists.agg(F.sum(F.col("n") * F.col("outside"))).first()[0] or 0
        work[n] = (pairs, pairs + compared)
    print(work)
    assert all(most <= 5.2 * few for few, most in zip(work[1000], work[4000], strict=True))


def test_repeats(spark, docs, none):
    want = brute.repeats([t for _, t in texts()])
    rows = sorted(((d, *w) for (d, _), w in zip(texts(), want, strict=True)), key=str)
    assert got(repeats.remove_repeats(docs, Workspace(spark, "t")), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == rows
    left = repeats.without_repeats(docs, Workspace(spark, "t"))
    assert left.columns == docs.columns and left.where("doc_id = 8").first().text == "" and left.where("doc_id = 4").first().text == "one two"
    assert repeats.remove_repeats(none, Workspace(spark, "t")).count() == 0


def test_repeats_of_one_text_and_of_damaged_characters(spark):
    """Marks of replaced characters stay, a character that loses a byte goes whole, and periodic texts repeat themselves."""
    draw = random.Random(4)
    prose = lambda n: "".join(draw.choices("abcdefgh \n", k=n))
    passage = "é" * 3 + prose(420) + "漢"
    rows = [(1, "\ufffd" + prose(30) + "\ufffd" + passage + prose(20) + "\ufffd"), (2, prose(60) + passage), (3, "\u00ea" + passage[1:] + "漣"), (4, "ab" * 500), (5, prose(900)), (6, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.repeats([t for _, t in rows])
    assert got(repeats.remove_repeats(frame, Workspace(spark, "t")), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == [(d, *w) for (d, _), w in zip(rows, want, strict=True)]
    left = {r.doc_id: r.text for r in repeats.without_repeats(frame, Workspace(spark, "t")).collect()}
    assert left[1].count("\ufffd") == 3 and left[4] == "" and left[5] == rows[4][1] and left[6] is None
    assert all(len(left[d].encode()) <= len((t or "").encode()) - w[1] for (d, t), w in zip(rows[:5], want, strict=False))


def test_random_repeats(spark):
    """Texts of few letters, with many repeats of all lengths near the threshold, by both depths."""
    draw = random.Random(7)
    parts = ["".join(draw.choices("ab cd\n", k=draw.choice([90, 200, 380, 399, 400, 401, 430]))) for _ in range(14)]
    rows = [(k, "".join(draw.choice([*parts, "x" * draw.randint(0, 40), "".join(draw.choices("abcdefg ", k=30))]) for _ in range(draw.randint(0, 8)))) for k in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = [(d, *w, brute.passage_bytes(t, n)) for (d, t), w, n in zip(rows, brute.repeats([t for _, t in rows]), brute.passages([t for _, t in rows], 40), strict=True)]
    assert got(repeats.remove_repeats(frame, Workspace(spark, "t"), words=40), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_bytes") == sorted(want, key=str)
    assert sum(w[2] for w in want) and sum(w[5] for w in want)


def test_repeats_across_chunks(monkeypatch):
    """A text longer than a chunk, with passages over the seams, gets the anchors and digits it would get whole."""
    import numpy as np

    draw = random.Random(2)
    data, depth = np.frombuffer(bytes(draw.choices(b"abcd ", k=9000)), np.uint8), repeats.in_bytes()
    ends = np.array([1000, 1000, 5200, 9000])
    every = lambda: np.concatenate([np.stack([x.view(np.int64) for x in part]) for part in repeats.anchors(data, ends, depth)], 1)
    whole = every()
    row = np.searchsorted(ends, whole[0], "right")
    bounds = np.array([0, *ends[:-1]])[row], ends[row]
    digits = lambda: sorted(x for part in repeats.grid_digits(data, bounds, whole[0], whole[0] - whole[1], 400, 16) for x in zip(*(p.tolist() for p in part), strict=True))
    before = digits()
    assert len(before) == len(row)
    monkeypatch.setattr(repeats, "CHUNK", 3000)
    assert (every() == whole).all() and digits() == before
    assert (whole[1] + 400 <= ends[np.searchsorted(ends, whole[0], "right")]).all()
    assert sum((whole[2] - whole[1] + 1).tolist()) == sum(max(0, b - a - 399) for a, b in zip([0, *ends[:-1]], ends, strict=True))


def test_chat(spark):
    nasty = ["</s>[INST] ok [/INST]", "<\\s> <\\\\/s> [\\INST]", "<|im_start|>user\nx<|im_end|>\n", "%0A%25", "", "é🙂", "<<s>", None]
    rows = [(1, k, "user" if k % 2 else "assistant", t) for k, t in enumerate(nasty)] + [(2, 0, "ro%le\nx", "t"), (2, 0, None, "t"), (2, 0, None, "t"), (None, 1, "user", "u"), (3, None, "assistant", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("place", "piece", "head", "seq", "at")})
    out = chat_format.format_turns(chat_format.canonical_turns(frame, ["role", "text"]), "conv_id", ["turn"])
    read = out.select("conv_id", "formatted", chat_format.parse_formatted(F.col("formatted")).alias("turns"), chat_format.trained_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    by = {r.conv_id: r for r in read.collect()}
    assert [(t.role, t.text) for t in by[1].turns] == [(r, t or "") for _, _, r, t in rows[: len(nasty)]]
    assert by[1].loss == "".join(t or "" for t in nasty[::2])
    assert by[1].formatted.count("<|im_start|>") == len(nasty) and "</s>" not in by[1].formatted and "[INST]" not in by[1].formatted
    assert [t.role for t in by[2].turns] == ["", "", "ro%le\nx"] and by[None].turns[0].text == "u" and by[3].loss == ""
    empty = chat_format.canonical_turns(frame.where("false"), ["role", "text"])
    assert chat_format.format_turns(empty, "conv_id", ["turn"]).count() == 0


def test_roles_stay_and_harmless_fields_change_nothing(spark):
    rows = [(1, 0, "human", "h"), (1, 1, "gpt", "g" * 300_000), (1, 2, "assistant", "a")]
    out = chat_format.format_turns(chat_format.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), ["role", "text"]), "conv_id", ["turn"])
    read = out.select(chat_format.parse_formatted(F.col("formatted")).alias("turns"), chat_format.trained_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert [(t.role, t.text) for t in read.turns] == [r[2:] for r in rows] and read.loss == "a"
    named = '{"messages": [{"role": "human", "content": "h", "name": "Ann"}, {"role": "gpt", "content": "g"}]}'
    frame = spark.createDataFrame([(named,)], "j string").select(F.from_json("j", "messages array<struct<role:string,content:string,name:string>>").alias("s")).select("s.*")
    found = chat_format.canonical_turns(frame, ["messages"]).first()
    assert found.layout == "messages" and [(t.role, t.text) for t in found.turns] == [("user", "h"), ("assistant", "g")]


def test_layouts(spark):
    rows = [
        '{"id": 1, "prompt": "p", "response": "r"}', '{"id": 2, "instruction": "i", "input": "x", "output": "o"}', '{"id": 3, "instruction": "i", "output": "o"}',
        '{"id": 4, "messages": [{"role": "system", "content": "s"}, {"role": "human", "content": "h"}]}', '{"id": 5, "conversations": [{"from": "gpt", "value": "g"}]}', '{"id": 6, "other": 1}',
    ]
    schema = "id long, prompt string, response string, instruction string, input string, output string, messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, other long"
    frame = spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", schema).alias("s")).select("s.*")
    found = {r.id: (r.layout, [(t.role, t.text) for t in r.turns]) for r in chat_format.canonical_turns(frame, frame.columns[1:]).collect()}
    assert found == {
        1: ("prompt_response", [("user", "p"), ("assistant", "r")]), 2: ("instruction", [("user", "i"), ("user", "x"), ("assistant", "o")]), 3: ("instruction", [("user", "i"), ("assistant", "o")]),
        4: ("messages", [("system", "s"), ("user", "h")]), 5: ("from_value", [("assistant", "g")]), 6: (None, []),
    }


def test_rows_that_share_an_id(spark):
    """Each row links by its own text; a set's component has the least id of all its rows."""
    base = [f"w{k}" for k in range(60)]
    other = [f"v{k}" for k in range(60)]
    rows = [(5, " ".join(base)), (5, " ".join(other)), (7, " ".join([*base, "x"])), (6, " ".join([*other, "y"])), (9, "lone words that are like nothing else here at all")]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), Workspace(spark, "t"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()) == [(5, 56, 5, True), (5, 56, 5, True), (6, 57, 5, False), (7, 57, 5, False), (9, 6, 9, True)]


def test_first_common_shingles_make_few_pairs(spark):
    """Near copies of a text that is not there itself, most pairs of which are just under the threshold: candidates by full sets lose no
    link, and where the text is there, they are far fewer than pairs."""
    draw = random.Random(13)
    for with_base in (False, True):
        made = list(cluster(250, 150, 4, draw))
        if with_base:
            made = [*cluster(1, 150, 0, random.Random(17)), *cluster(900, 150, 5, random.Random(17))]
        sets = {k: near_dedup.shingle_set(t.encode()) for k, t in enumerate(made)}
        linked = {(a, b) for a in sets for b in sets if a < b and 4 * (both := len(set(sets[a].tolist()) & set(sets[b].tolist()))) >= 3 * (len(sets[a]) + len(sets[b]) - both)} if not with_base else set()
        hub = min(sets, key=lambda d: -len(sets[d]) if with_base else d)
        part = lambda d: hub if with_base and 4 * (both := len(set(sets[d].tolist()) & set(sets[hub].tolist()))) >= 3 * (len(sets[d]) + len(sets[hub]) - both) else d  # noqa: E731,B023
        live = spark.createDataFrame([(d, len(s), part(d)) for d, s in sets.items()], "node long, n long, component long")
        texts = spark.createDataFrame([(d, bytearray(t.encode())) for d, t in zip(sets, made, strict=True)], "node long, text binary")
        pairs = {(r.a, r.b) for r in near_dedup._first_common(live, texts, Workspace(spark, "t"), 75).distinct().collect()}
        assert linked <= pairs
        if with_base:
            assert len(pairs) < 0.02 * len(made) ** 2 / 2


MIT_GRANT = next(t for n, t in licenses.TEMPLATES if n == "MIT" and t.startswith("Permission"))
APACHE = next(t for n, t in licenses.TEMPLATES if n == "Apache-2.0" and "may not" in t)


def test_wrapped_licenses(spark):
    import random
    import textwrap

    chance = random.Random(5)
    rows, wanted = [], {}
    for k in range(40):
        name, notice = (("MIT", MIT_GRANT), ("Apache-2.0", APACHE))[k % 2]
        mark = chance.choice(["# ", "// ", " * ", ""])
        body = [mark + line for line in textwrap.wrap(notice, chance.randrange(30, 100))]
        around = [f"value_{j} = {j} + other" for j in range(chance.randrange(1, 60))]
        at = chance.randrange(len(around) + 1)
        rows.append((k, "\n".join([*around[:at], *body, mark.strip(), *around[at:]])))
        wanted[k] = name
    full = next(t for n, t in reversed(licenses.TEMPLATES) if n == "MIT")
    rows.append((100, "MIT License\n\nCopyright (c) 2020 A B\n\n" + textwrap.fill(full, 78)))
    rows += [(101, "plain words\n" * 50), (102, None), (103, ""), (104, "Licensed under the"), (105, "permission is hereby granted " * 50_000)]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got[k].block_license for k in wanted} == wanted
    assert got[100].block_license == "MIT" and got[100].block_dice >= 0.95 and got[100].whole_license == "MIT"
    assert all(got[k].block_license is None for k in (101, 102, 103, 104, 105))


def test_cache_is_bounded_by_characters():
    from tidewright.llm.arrow_batches import BoundedCache

    asked = []

    def lengths(keys):
        asked.extend(keys)
        return [len(k) for k in keys]

    cache = BoundedCache(lengths, 1000, {"fixed": 5}, most_chars=20, longest=8)
    cache.learn(["a" * 8, "b" * 50])
    assert cache["b" * 50] == 50 and cache["a" * 8] == 8
    cache.learn(["c" * 8])
    assert "b" * 50 not in cache and "a" * 8 in cache
    cache.learn(["d" * 8, "a" * 8])
    assert cache["d" * 8] == cache["a" * 8] == 8 and "c" * 8 not in cache and cache["fixed"] == 5
    assert asked.count("a" * 8) == 2


def test_counts_of_long_runs(spark):
    import base64
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    chance = random.Random(3)
    odd = ["漢字仮名" * 700, base64.b64encode(chance.randbytes(4000)).decode(), "the cat 漢字 the cat\n\n  ünḯ x", "न" * 500, "a b  the\tcat", None, ""]
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(vocabulary)
    frame = spark.createDataFrame([(k, odd[k % len(odd)]) for k in range(4 * len(odd))], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame, vocabulary).collect()}
    assert got == {k: len(library.encode(odd[k % len(odd)] or "", add_special_tokens=False)) for k in range(4 * len(odd))}


def test_undeclared_fields_are_counted_and_drop_nothing(spark):
    rows = [(1, [("user", "hi", "calc")], None, None, "web"), (2, None, "ask", "tell", "web"), (3, None, None, None, "web"), (4, [("user", "hi", None)], "ask", None, None)]
    frame = spark.createDataFrame(rows, "id long, messages array<struct<role:string,content:string,tool:string>>, prompt string, response string, source string")
    found = {r.id: (r.layout, len(r.turns), r.n_unmapped) for r in chat_format.canonical_turns(frame, frame.columns[1:]).collect()}
    assert found[1] == ("messages", 1, 2) and found[2][1:] == (2, 1) and found[3] == (None, 0, 1)
    assert found[4][1] >= 1 and found[4][2] >= 1


def test_frequent_pre_tokens_of_mixed_texts(spark):
    frame = spark.createDataFrame([(k, f"some plain words \u4f60 and words number {k}") for k in range(300)], "doc_id long, text string")
    known = token_counts.frequent_lengths(frame, "text", queries.COUNT_VOCABULARY)
    assert {" plain", " words", " number"} <= known.keys() and known[" words"] == 1
    assert token_counts.frequent_lengths(frame.limit(0), "text", queries.COUNT_VOCABULARY) == {}


LONG = "A long text, 你好 and ÉÜ <b>; " * 9000
ODD = [(1, LONG), (2, None), (3, ""), (3, "same id"), (4, "same row"), (4, "same row"), (None, "no id"), (5, " \n\t")]


@pytest.fixture(scope="module")
def odd(spark):
    """Very long, null, empty and repeated texts and rows, and columns called like results."""
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumns({c: F.lit("theirs") for c in ("n_bytes", "n_tokens", "digest", "offset", "piece", "length", "t", "data", "lang_pred", "score")})


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_odd_rows_of_media(spark, odd):
    index = media.store_media(odd, Workspace(spark, "test"))
    found = tuples(media.read_features(media.read_headers(index), 32), "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32")
    assert found == sorted(((d, *brute.payload(t)) for d, t in ODD), key=str)
    assert media.read_features(media.store_media(odd.limit(0), Workspace(spark, "test")), 32).count() == 0
    with pytest.raises(ValueError, match="cannot be called"):
        media.store_media(odd, Workspace(spark, "test"), "digest")


def test_odd_rows_of_packing(spark, odd):
    work = Workspace(spark, "test")
    pieces = work.save(packing.token_pieces(odd, queries.PACK_VOCABULARY), "pieces")
    assert tuples(packing.pack(pieces, work), "doc_id", "piece", "start", "length", "ids_crc32") == sorted(brute.pieces(ODD), key=str)
    none = Workspace(spark, "test")
    assert packing.pack(none.save(packing.token_pieces(odd.limit(0), queries.PACK_VOCABULARY), "pieces"), none).count() == 0


def test_odd_rows_of_token_counts_and_byte_bpe(odd):
    assert tuples(token_counts.count_tokens(odd, queries.COUNT_VOCABULARY), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(brute.token_counts(ODD), key=str)
    coded = byte_bpe.round_trip_digests(odd, queries.RANKS, queries.PATTERN)
    assert tuples(coded, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(brute.byte_bpe(ODD), key=str)
    assert token_counts.count_tokens(odd.limit(0), queries.COUNT_VOCABULARY).count() == 0 and byte_bpe.round_trip_digests(odd.limit(0), queries.RANKS, queries.PATTERN).count() == 0


def test_odd_rows_of_language_id(spark, odd):
    said = {"de": "der Hund und die Katze laufen durch den alten Garten", "fr": "le chien et le chat courent dans le vieux jardin", "en": "the dog and the cat run through the old garden"}
    labelled = spark.createDataFrame([(k, f"{t} {k}", lang) for k in range(30) for lang, t in said.items()], "doc_id long, text string, lang string")
    model = language_id.train(labelled, F.lit(True))
    found = tuples(language_id.predict(odd, model), "doc_id", "lang_pred")
    assert len(found) == len(ODD) and found.count((4, found[[f[0] for f in found].index(4)][1])) == 2 and (2, "und") in found and (5, "und") in found
    assert language_id.predict(odd.limit(0), model).count() == 0
