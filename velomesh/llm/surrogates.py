"""Personal data replaced by keyed surrogates of the same kind and form.

Entities are found by patterns: e-mail addresses, IPv4 addresses, telephone numbers, payment cards with a
valid check digit, secrets in quotes behind a telling name, and persons behind a form of address. All ways to write an
entity fold to one canonical form, so each mention gets the same surrogate (coreference). A surrogate is made from
an HMAC-SHA256 of the canonical form under a secret key: letters by letters of the same script and
case, digits by digits, punctuation as it stands; cards get a valid check digit, addresses valid octets, persons a name
whose ending fits the form of address. Surrogates that meet each other, or an entity that occurs, are made anew with
the next counter until all differ (distinctness). All of it is DataFrame work.

Defined results: a null text stays null; a text without entities is unchanged; rows are replaced one by one, whatever
their identity; an empty table gives an empty result; the other columns stay as they are.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomesh.llm.common import stored

#: Names the environment variable of the key; the fallback serves tests and the registered query.
KEY_NAME, TEST_KEY = "SURROGATE_KEY", "surrogate-test-key"

# Forms of address by gender.
MALE = ["Mr", "Mister", "Sir", "Monsieur", "Herr", "Señor", "Don", "Господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Madame", "Mademoiselle", "Frau", "Señora", "Señorita", "Doña", "Госпожа"]
# Letters of each script that surrogates use, lower case.
SCRIPTS = {"Latin": "abcdefghijklmnopqrstuvwxyz", "Cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "Greek": "αβγδεζηθικλμνξοπρστυφχψω"}
# Of each other script the range of its codes, and a run of its letters, first and number.
RANGES = [
    (0x0530, 0x058F, 0x0561, 38), (0x0590, 0x05FF, 0x05D0, 27), (0x0600, 0x06FF, 0x0627, 20), (0x0700, 0x074F, 0x0712, 27),
    (0x0750, 0x077F, 0x0627, 20), (0x0780, 0x07BF, 0x0780, 38), (0x0900, 0x097F, 0x0915, 37), (0x0980, 0x09FF, 0x0995, 20),
    (0x0A00, 0x0A7F, 0x0A15, 20), (0x0A80, 0x0AFF, 0x0A95, 20), (0x0B00, 0x0B7F, 0x0B15, 20), (0x0B80, 0x0BFF, 0x0BAE, 12),
    (0x0C00, 0x0C7F, 0x0C15, 20), (0x0C80, 0x0CFF, 0x0C95, 20), (0x0D00, 0x0D7F, 0x0D15, 20), (0x0D80, 0x0DFF, 0x0D9A, 24),
    (0x0E00, 0x0E7F, 0x0E01, 46), (0x0E80, 0x0EFF, 0x0E94, 4), (0x0F00, 0x0FFF, 0x0F49, 33), (0x1000, 0x109F, 0x1000, 34),
    (0x10A0, 0x10FF, 0x10D0, 33), (0x1100, 0x11FF, 0xAC00, 11172), (0x1200, 0x139F, 0x1208, 63), (0x1780, 0x17FF, 0x1780, 35),
    (0x1800, 0x18AF, 0x1820, 35), (0x1C90, 0x1CBF, 0x10D0, 33), (0x3041, 0x309F, 0x3042, 82), (0x30A0, 0x30FF, 0x30A2, 82),
    (0x3100, 0x312F, 0x3105, 37), (0x3130, 0x318F, 0xAC00, 11172), (0x3400, 0x9FFF, 0x4E00, 20902),
    (0xAC00, 0xD7AF, 0xAC00, 11172), (0xF900, 0xFAFF, 0x4E00, 20902), (0xD840DC00, 0xD88CDFFF, 0x4E00, 20902)]
# Zeros of other decimal digits, in whose ten places the others follow.
ZEROS = [0x0660, 0x06F0, 0x0966, 0x09E6, 0x0E50, 0xFF10]
_LETTERS, _DIGITS = ("array(" + ", ".join(
    f"named_struct('low', {low}L, 'high', {high}L, 'first', {first}L, 'many', {many})" for low, high, first, many in table) + ")"
    for table in (RANGES, [(z, z + 9, z, 10) for z in ZEROS]))
# Endings of given names by script: male, female.
ENDINGS = {"Latin": ("o", "a"), "Cyrillic": ("й", "а"), "Greek": ("ος", "α")}

#: What stands before a secret, and before a person's name.
CUE = r"(?i:token|secret|password|passwd|api_key|apikey|access_key) {0,2}[=:] {0,2}[\"']"
ADDRESS = r"\b(?:" + "|".join(MALE + FEMALE) + r")\.? "
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{M}\p{N}._%+-]*@[\p{L}\p{N}][\p{L}\p{M}\p{N}-]*(?:\.[\p{L}\p{M}\p{N}-]+)*\.\p{L}[\p{L}\p{M}]+",
    "secret": rf"(?<={CUE})[^\"'\s]{{6,}}(?=[\"'])",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
    "card": r"(?<![\p{L}\p{N}.+-])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}]|[.-]\d)",
    "phone": r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}])\+\d{1,3}(?:[ .-]?\d){7,12}(?![\p{L}\p{N}])",
    "person": rf"(?<={ADDRESS})\p{{Lu}}\p{{Ll}}+(?:[ -]\p{{Lu}}\p{{Ll}}+)?",
}
#: Kinds in the order in which they are tried at a place.
KINDS = ["email", "secret", "card", "phone", "ip", "person"]
ANY = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS)
#: Every text with a match has one of these; quick to rule out.
HINT = r"[@\d\"']|" + ADDRESS


def key() -> str:
    return os.environ.get(KEY_NAME, TEST_KEY)


def _luhn(digits: Column) -> Column:
    """Sum of a digit string by the check rule of payment cards, the last digit counted once."""
    each = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    weighed = F.transform(each, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.floor(c.cast("int") / 5).cast("int") + c.cast("int") * 2 % 10))
    return F.aggregate(weighed, F.lit(0), lambda s, x: s + x)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def kind_of(found: Column, before: Column) -> Column:
    """Kind of a match, given the text before it; null for card-like numbers whose check digit is wrong."""
    return (F.when(before.rlike(f"{CUE}$"), "secret").when(before.rlike(f"{ADDRESS}$"), "person")
            .when(found.contains("@"), "email").when(found.rlike(f"^(?:{PATTERNS['ip']})$"), "ip")
            .when(found.rlike(r"^\d(?:[ -]?\d){12,18}$"), F.when(_luhn(_digits(found)) % 10 == 0, "card"))
            .otherwise("phone"))


def canonical(kind: Column, found: Column) -> Column:
    """The form that all mentions of an entity share; of a phone or card its digits, else lower case."""
    return F.when(kind.isin("card", "phone"), _digits(found)).when(kind == "secret", found).otherwise(F.lower(found))


def _hmac(secret: str, message: Column) -> Column:
    """HMAC-SHA256 in hexadecimal digits."""
    block = secret.encode()[:64].ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))), 256)


def _number(stream: str, at: Column, below: Column | int) -> Column:
    """A number below ``below`` from four hexadecimal digits of the stream, taken in turn."""
    start = F.pmod(at * 4, F.length(stream) - 3) + 1
    return (F.conv(F.substring(F.col(stream), start, F.lit(4)), 16, 10).cast("int") % below).cast("int")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _letter(alphabet: str, stream: str, at: Column) -> Column:
    return F.substring(F.lit(alphabet), _number(stream, at, len(alphabet)) + 1, F.lit(1))


def _alike(c: Column, at: Column, stream: str) -> Column:
    """A character of the same class: digit, or letter of the same script; marks and punctuation as they stand.

    Letters of scripts without a range become Latin ones, other numerals digits, so that none is left.
    """
    out = F.when(c.rlike(r"^\d$"), _number(stream, at, 10).cast("string"))
    for script, alphabet in SCRIPTS.items():
        out = out.when(c.rlike(rf"^\p{{Is{script}}}$"), _letter(alphabet, stream, at))
    code = F.conv(F.hex(F.encode(c, "UTF-16BE")), 16, 10).cast("long")
    run = lambda table: F.get(F.filter(F.expr(table), lambda r: (r["low"] <= code) & (code <= r["high"])), F.lit(0))
    drawn = lambda r: F.decode(F.unhex(F.lpad(F.hex(r["first"] + _number(stream, at, r["many"])), 4, "0")), "UTF-16BE")
    return (out.when(c.rlike(r"^\p{N}$"), F.coalesce(drawn(run(_DIGITS)), _number(stream, at, 10).cast("string")))
            .when(c.rlike(r"^\p{L}$"), F.coalesce(drawn(run(_LETTERS)), _letter(SCRIPTS["Latin"], stream, at))).otherwise(c))


def _spelled(text: Column, stream: str, shift: int = 0) -> Column:
    return F.array_join(F.transform(_chars(text), lambda c, i: _alike(c, i + shift, stream)), "")


def surrogate(kind: Column, form: Column, gender: Column, stream: str, turn: Column) -> Column:
    """The canonical form's surrogate. From the third turn on, more letters or digits make room where there is little."""
    longer = F.when(turn >= 3, F.array_join(F.transform(F.sequence(F.lit(3), turn), lambda t: _alike(
        F.substring(form, 1, 1), t + 40, stream)), "")).otherwise("")
    local, host = F.substring_index(form, "@", 1), F.substring_index(form, "@", -1)
    top = F.substring_index(host, ".", -2)
    below = F.substring(host, F.lit(1), F.length(host) - F.length(top))
    mail = F.concat(_spelled(local, stream), longer, F.lit("@"), _spelled(below, stream, 24), top)
    octet = lambda i: (_number(stream, F.lit(i), 254) + 1).cast("string")
    address = F.concat_ws(".", *map(octet, range(4)))
    number = F.concat(F.substring(form, 1, 1), _spelled(F.substring(form, F.lit(2), F.length(form) - 2), stream))
    check = ((10 - _luhn(F.concat(number, F.lit("0"))) % 10) % 10).cast("string")
    country = F.greatest(F.length(form) - 10, F.lit(0))
    phone = F.concat(F.substring(form, F.lit(1), country),
                     _spelled(F.substring(form, country + 1, F.length(form)), stream))
    ending = F.lit("")
    for script, (male, female) in ENDINGS.items():
        ending = F.when(form.rlike(rf"^\p{{Is{script}}}"), F.when(gender == "f", female).otherwise(male)).otherwise(ending)
    # the given name comes first; a family name behind it has no gender here
    parts = F.split(form, "[ -]")
    given = F.concat(_spelled(F.element_at(parts, 1), stream), longer, ending)
    gap = F.regexp_extract(form, "[ -]", 0)
    family = F.when(F.size(parts) > 1, F.concat(gap, _spelled(F.get(parts, F.lit(1)), stream, 20))).otherwise("")
    # hexadecimal secrets stay hexadecimal, others keep their classes; case is put back per mention
    hexed = F.array_join(F.transform(_chars(form), lambda c, i: F.when(
        c.rlike("^[A-F]$"), F.upper(F.substring(F.lit("0123456789abcdef"), _number(stream, i, 6) + 11, F.lit(1))))
        .when(c.rlike("^[a-f]$"), F.substring(F.lit("0123456789abcdef"), _number(stream, i, 6) + 11, F.lit(1)))
        .otherwise(_number(stream, i, 10).cast("string"))), "")
    room = F.when(turn >= 3, F.array_join(F.transform(F.sequence(F.lit(3), turn), lambda t: _number(
        stream, t + 40, 10).cast("string")), "")).otherwise("")
    plain = F.array_join(F.transform(_chars(form), lambda c, i: F.when(
        c.rlike(r"^\p{Lu}$"), F.upper(_alike(c, i, stream))).otherwise(_alike(c, i, stream))), "")
    return (F.when(kind == "email", mail).when(kind == "ip", address).when(kind == "card", F.concat(number, check))
            .when(kind == "phone", phone).when(kind == "person", F.concat(given, family))
            .otherwise(F.concat(F.when(form.rlike("^[0-9a-fA-F]+$"), hexed).otherwise(plain), room)))


def rendered(kind: Column, found: Column, new: Column) -> Column:
    """A surrogate in the form of the mention: its punctuation among digits, its capitals."""
    filled = F.aggregate(
        _chars(found), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.struct(F.concat(s["out"], F.when(c.rlike(r"^\d$"), F.substring(new, s["at"], F.lit(1))).otherwise(c)).alias("out"),
                              (s["at"] + c.rlike(r"^\d$").cast("int")).alias("at")),
        lambda s: s["out"])
    return (F.when(kind.isin("card", "phone"), filled)
            .when(kind == "secret", new)
            .when((found == F.upper(found)) & (F.upper(found) != F.lower(found)), F.upper(new))
            .when(kind == "person", F.initcap(new)).otherwise(new))


def has_match(text: str) -> Column:
    return F.col(text).rlike(HINT) & F.col(text).rlike(ANY)


def _mentions(docs: DataFrame) -> DataFrame:
    """Rows with a match, stored: the row itself, the text between matches, and what comes before each match."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col("text").alias("_text"))
    rows = rows.where(has_match("_text")).withColumn("_row", F.monotonically_increasing_id())
    rows = rows.withColumns({"_found": F.regexp_extract_all("_text", F.lit(ANY), F.lit(0)), "_between": F.split("_text", ANY, -1)})
    return stored(rows.drop("_text"), "mentions")


def entities(mentions: DataFrame) -> DataFrame:
    """(row, at, found, kind, form, gender) of every mention that is an entity."""
    each = mentions.select("_row", "_between", F.posexplode("_found").alias("_at", "_match"))
    before = F.element_at("_between", F.col("_at") + 1)
    each = each.withColumn("kind", kind_of(F.col("_match"), before)).where("kind is not null")
    female = before.rlike(r"\b(?:" + "|".join(FEMALE) + r")\.? $")
    return each.select("_row", "_at", F.col("_match").alias("found"), "kind", canonical(F.col("kind"), F.col("_match")).alias("form"),
                       F.when(F.col("kind") == "person", F.when(female, "f").otherwise("m")).otherwise("").alias("gender"))


def mapping(found: DataFrame, secret: str) -> DataFrame:
    """(kind, gender, form, new): one surrogate per entity, no two alike, none an entity that occurs.

    Each turn settles all forms whose surrogate is free; of those that meet, the least stays.
    """
    known = stored(found.select("kind", "gender", "form").distinct(), "entities")
    open_, settled, turn = known, None, 0
    while True:
        message = F.concat_ws("\x1f", "kind", "gender", "form", F.lit(str(turn)))
        stream = open_.withColumn("_s", _hmac(secret, message)).withColumn("_s", F.concat("_s", _hmac(secret, F.col("_s"))))
        tried = stream.withColumn("new", surrogate(F.col("kind"), F.col("form"), F.col("gender"), "_s", F.lit(turn))).drop("_s")
        taken = known.select("kind", F.col("form").alias("new"))
        if settled is not None:
            taken = taken.union(settled.select("kind", "new"))
        tried = stored(tried, "surrogates")
        # with room added, a mail box may hold the real one whole
        real, box = F.substring_index("form", "@", 1), F.substring_index("new", "@", 1)
        least = tried.where((F.col("kind") != "email") | ~F.contains(box, real)).groupBy("kind", "new").agg(F.min("form").alias("_form"))
        free = least.join(taken.distinct(), ["kind", "new"], "left_anti")
        # one form can be both a man's and a woman's name; genders end differently, so only forms can meet
        good = tried.join(free, ["kind", "new"]).where("form = _form").select("kind", "gender", "form", "new")
        good = stored(good.groupBy("kind", "new").agg(F.min("gender").alias("gender"), F.min("form").alias("form"))
                      .select("kind", "gender", "form", "new"), "surrogates")
        settled = good if settled is None else settled.union(good)
        open_ = stored(tried.drop("new").join(good, ["kind", "gender", "form"], "left_anti"), "surrogates")
        if open_.isEmpty():
            return settled
        turn += 1


def replace(docs: DataFrame, secret: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``docs`` with surrogates in the text and a column ``replaced`` (their number); and the mapping.

    Rows without a match never leave their task.
    """
    mentions = _mentions(docs)
    found = stored(entities(mentions), "entities")
    table = stored(mapping(found, secret or key()), "surrogates")
    fresh = found.join(table, ["kind", "gender", "form"]).select(
        "_row", F.struct("_at", rendered(F.col("kind"), F.col("found"), F.col("new")).alias("new")).alias("one"))
    fresh = fresh.groupBy("_row").agg(F.map_from_entries(F.collect_list("one")).alias("_new"))
    put = F.transform("_found", lambda f, i: F.coalesce(F.element_at("_new", i), f))
    text = F.concat(F.array_join(F.transform(F.arrays_zip(F.slice("_between", 1, F.size("_found")).alias("b"), put.alias("p")),
                                             lambda z: F.concat(z["b"], z["p"])), ""), F.element_at("_between", -1))
    changed = mentions.join(fresh, "_row", "left").select(
        "_doc", text.alias("_text"), F.coalesce(F.size("_new"), F.lit(0)).alias("replaced"))
    names = docs.columns
    changed = changed.select(*[F.col("_text").alias("text") if c == "text" else F.col("_doc")[c].alias(c) for c in names], "replaced")
    same = docs.where(F.coalesce(~has_match("text"), F.lit(True))).withColumn("replaced", F.lit(0))
    return same.select(*[F.col(f"`{c}`") for c in names], F.lit(0).alias("replaced")).union(changed), table
