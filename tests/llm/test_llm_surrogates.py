"""Surrogates: hand cases, and the promises that every replacement keeps."""

import re
import unicodedata

from pyspark.sql import functions as F

from velomesh.llm import surrogates
from velomesh.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def luhn(digits):
    x = [int(c) for c in digits][::-1]
    return (sum(x[::2]) + sum(sum(divmod(2 * y, 10)) for y in x[1::2])) % 10 == 0


def run(spark, texts, secret="k", **extra):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumns(extra)
    out, table = surrogates.replace(docs, secret)
    return {r.doc_id: r for r in out.collect()}, {(r.kind, r.gender, r.form): r.new for r in table.collect()}, out.columns


TEXTS = [
    "mail jo.81@mail3.example.com and Jo.81@Mail3.example.com, JO.81@MAIL3.EXAMPLE.COM.",
    "call +1 (017) 555-7713 or +1 017 555 7713 now",
    "card 4539 1488 0343 6467 or 4539148803436467 or 4539-1488-0343-6467, not 4539148803436468",
    "host 226.203.165.104, not 999.1.1.1 nor 1.2.3.4.5",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!! password: \'s3cret-Pass\'',
    "Mr. Smith met Mrs Smith and Herr Anna; Госпожа Иванова, Господин Иванов, Mr Παύλος; smith stayed",
    "nothing here 12 34.5, a@b, 2024-01-02",
    None, "", "x" * 200_000 + " jo.81@mail3.example.com",
]


def test_hand_cases(spark):
    got, table, _ = run(spark, TEXTS)
    lines = {i: r.text for i, r in got.items()}
    a, b, c = re.findall(r"\S+@\S+(?<![.,])", lines[0].rstrip("."))
    assert a.lower() == b.lower() == c.lower() and c == c.upper() and "jo.81" not in a
    assert re.fullmatch(r"[a-z]{2}\.\d\d@[a-z]{4}\d\.example\.com", a)
    assert lines[9].endswith(" " + a)
    one, two = re.fullmatch(r"call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1 \d{3} \d{3} \d{4}) now", lines[1]).groups()
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two) != "10175557713"
    cards = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}) or (\d{16}) or (\d{4}-\d{4}-\d{4}-\d{4}), not 4539148803436468", lines[2]).groups()
    plain = {re.sub(r"\D", "", x) for x in cards}
    assert len(plain) == 1 and luhn(min(plain)) and min(plain) != "4539148803436467" and min(plain)[0] == "4"
    octets = re.fullmatch(r"host (\d+)\.(\d+)\.(\d+)\.(\d+), not 999.1.1.1 nor 1.2.3.4.5", lines[3]).groups()
    assert all(0 < int(x) < 256 for x in octets) and ".".join(octets) != "226.203.165.104"
    low, high, word = re.findall("[\"'](.*?)[\"']", lines[4])
    assert re.fullmatch("[0-9a-f]{40}", low) and re.fullmatch("[0-9A-F]{40}", high) and re.fullmatch(r"[a-z]\d[a-z]{4}-[A-Z][a-z]{3}", word)
    him, her, anna, ivanova, ivanov, paul = re.fullmatch(
        r"Mr\. (\w+) met Mrs (\w+) and Herr (\w+); Госпожа (\w+), Господин (\w+), Mr (\w+); smith stayed", lines[5]).groups()
    assert him.endswith("o") and her.endswith("a") and anna.endswith("o") and "Smith" not in (him, her)
    assert re.fullmatch("[А-я]+а", ivanova) and re.fullmatch("[А-я]+й", ivanov) and re.fullmatch("[Ͱ-Ͽ]+ος", paul)
    assert all(x[0].isupper() for x in (him, her, ivanova, paul))
    assert lines[6] == TEXTS[6] and lines[7] is None and lines[8] == ""
    assert [got[i].replaced for i in range(10)] == [3, 2, 3, 1, 3, 6, 0, 0, 0, 1]
    assert len(table) == len(set((k[0], v) for k, v in table.items()))


def test_key_decides_and_reruns_agree(spark):
    one, table, _ = run(spark, TEXTS[:6])
    again, _, _ = run(spark, TEXTS[:6])
    other, _, _ = run(spark, TEXTS[:6], "another")
    assert one == again
    assert all(one[i].text != other[i].text for i in range(6))


def test_surrogates_stay_distinct_where_room_is_short(spark):
    """Thirty-six one-letter, one-digit mail boxes share 26 x 10 forms; none may meet, nor hit a real one."""
    mails = [f"{a}{d}@x.org" for a in "abcdefghijklmnopqrstuvwxyz" for d in range(10)]
    got, table, _ = run(spark, [f"to {m} now" for m in mails])
    new = [v for v in table.values()]
    assert len(new) == len(set(new)) == len(mails) and not set(new) & set(mails)
    assert all(got[i].text == f"to {table['email', '', m]} now" for i, m in enumerate(mails))


def test_columns_stay_and_clash(spark):
    got, _, columns = run(spark, TEXTS, **{"_doc": F.lit(5), "kind": F.lit("k"), "_row": F.lit(1.5), "new": F.lit(None).cast("string")})
    assert columns == ["doc_id", "text", "_doc", "kind", "_row", "new", "replaced"]
    assert all(r["_doc"] == 5 and r.kind == "k" and r["_row"] == 1.5 for r in got.values())
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert surrogates.replace(docs)[0].count() == 0
    twice = spark.createDataFrame([(1, "to a.1@x.org"), (1, "to a.1@x.org"), (None, "to a.1@x.org")], "doc_id long, text string")
    assert len({r.text for r in surrogates.replace(twice)[0].collect()}) == 1


def test_letters_of_every_script_are_replaced(spark):
    boxes = {"CJK": "张伟明", "HANGUL": "김철수", "HIRAGANA": "さくら", "KATAKANA": "サクラ", "ARABIC": "محمد", "HEBREW": "משה",
             "DEVANAGARI": "राम", "THAI": "สมชาย", "ARMENIAN": "արամ", "GEORGIAN": "გია", "TAMIL": "மணி", "ETHIOPIC": "አበበ",
             "LATIN": "ⲁⲃⲅ"}  # Coptic has no table
    got, table, _ = run(spark, [f"to {b}@{b}.例子.中国 now" for b in boxes.values()] + [f"token = \"{b}{b}x9\"" for b in boxes.values()]
                        + ["to a٣٤٥٦@x.org now"])
    for i, (script, box) in enumerate(boxes.items()):
        new, domain = re.fullmatch(r"to (\S+)@(\S+)\.例子\.中国 now", got[i].text).groups()
        secret = re.fullmatch(r'token = "(.+)"', got[i + len(boxes)].text)[1]
        assert len(new) == len(box) and box not in new + domain + secret
        for a, b in zip(box * 2, new + domain):
            assert unicodedata.name(b).startswith(script) if unicodedata.category(a)[0] == "L" else a == b
        assert all(unicodedata.name(b).startswith(script) for a, b in zip(box * 2, secret) if unicodedata.category(a)[0] == "L")
    assert re.fullmatch("to [a-z][٠-٩]{4}@x.org now", got[2 * len(boxes)].text) and "٣٤٥٦" not in got[2 * len(boxes)].text
    assert all(f.split("@")[0] not in new.split("@")[0] for (kind, _, f), new in table.items() if kind == "email")


def test_registered_query_keeps_form_everywhere(spark):
    """Brute force over the whole table: the text outside entities, coreference and distinctness."""
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    after = {r.doc_id: r for r in QUERIES["op5_surrogates"](spark, SMALL).collect()}
    assert before.keys() == after.keys()
    entity = re.compile(r"[\w.]+@\w+\.\w+\.\w+|(?<=token = \")[0-9a-f]{40}|(?<=TOKEN = \")[0-9A-F]{40}|\+\d \(\d{3}\) \d{3}-\d{4}"
                        r"|(?<![\w.])\d{16}(?!\w)|(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w)")
    seen = {}
    for i, text in before.items():
        new = after[i].text
        assert entity.split(text) == entity.split(new), i
        changed = 0
        for a, b in zip(entity.findall(text), entity.findall(new)):
            if re.fullmatch(r"\d{16}", a) and not luhn(a):
                assert a == b
                continue
            changed += 1
            assert a != b and seen.setdefault(a.lower(), b.lower()) == b.lower()
            assert not re.fullmatch(r"\d{16}", a) or luhn(b)
            assert re.sub(r"\w+", "w", a) == re.sub(r"\w+", "w", b)
        assert after[i].replaced == changed
    assert len(set(seen.values())) == len(seen) and not set(seen.values()) & set(seen)
