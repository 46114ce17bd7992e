"""Labelled findings made for training the secret scanner: values of many forms, drawn row by row with DataFrame functions.

A form says how its values look and what stands around them on their line. Secrets are key ids, tokens with and
without known beginnings, and values under a secret's name; the others are what looks like them: checksums, ids,
numbers, versions, hosts, paths, coded prose, placeholders. Forms in ``HELD_OUT`` can be left out of the training,
to measure how the forest judges forms that it doesn't know.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import secrets

KNOWN_ROWS = 4_000  # rows that ``known_findings`` makes

UPPER, DIGITS, HEX = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
LETTERS = UPPER + UPPER.lower()
ANY = LETTERS + DIGITS
BASE64 = ANY + "+/"
SAFE64 = ANY + "_-"

#: fixed values: plain words for prose, names and paths
WORDS = (
    "account after along amount apple archive author backup battery before border bridge browser build butter canvas carbon castle center change channel"
    " circle client cloud common config corner correct cotton country current default deploy desert detail device dinner dragon editor engine event example"
    " export family farmer feature filter flower folder forest garden global golden handle harbor history horse image import index island journal kernel"
    " kitchen ladder language letter library light listen little logger machine manager market master matter member memory message meter middle mirror module"
    " monkey morning mountain number object office orange output package paper parser people person phone picture planet player pocket portal print process"
    " profile project public queue random reader record region release remote report request river sample scale school screen script search season section"
    " server service shadow silver simple single sister small smooth source spring staple station stone stream street string summer sunset system table"
    " target team template theme thing thread ticket timer tomato tower travel update user valley value vector version video village wallet water weather"
    " widget window winter wonder worker yellow"
).split()


def _number(n: int | Column, *salt: int | Column) -> Column:
    """From 0 to n - 1, by the row's number ``i``."""
    return F.pmod(F.xxhash64("i", *(s if isinstance(s, Column) else F.lit(s) for s in salt)), F.lit(n)).cast("int")


def _list(options: list[str]) -> Column:
    """One literal is cut, which the planner does once."""
    return F.split(F.lit("\n".join(options)), "\n")


def _one(options: list[str], salt: int) -> Column:
    return F.element_at(_list(options), _number(len(options), salt) + 1)


def _draw(letters: str, least: int, salt: int, most: int = 0) -> Column:
    """``least`` characters, or up to ``most``."""
    n = F.lit(least) if most <= least else least + _number(most - least + 1, salt, 1)
    each = F.transform(F.sequence(F.lit(1), n), lambda j: F.substr(F.lit(letters), _number(len(letters), salt, 2, j) + 1, F.lit(1)))
    return F.array_join(each, "")


def _word(salt: int) -> Column:
    return _one(WORDS, salt)


def _words(n: int, sign: str, salt: int) -> Column:
    return F.concat_ws(sign, *(_word(salt + k) for k in range(n)))


def _uuid() -> Column:
    return F.concat_ws("-", *(_draw(HEX, n, 30 + k) for k, n in enumerate((8, 4, 4, 4, 12))))


NAMED = ['password = "', "password: ", "passwd=", 'token = "', "token=", "api_key=", 'api_key: "', "secret: ", 'client_secret = "', "auth_token=", "access_key: ", 'DB_PASSWORD="', '"secret_key": "', "credentials = '"]
LOOSE = ["", "use ", "key ", "with ", "key: ", "export KEY=", "see ", "X-Key: ", '"', "= ", "my key is ", "curl -u ", "Authorization: Bearer ", "- "]
PLAIN = ["", "see ", "in ", "id ", "the ", "from ", "- ", "of ", '"', "name: ", "x = ", "ref=", "(", "was "]

#: form: (label, what stands before, the value)
FORMS: dict[str, tuple[int, list[str], Callable[[], Column]]] = {
    "key id": (1, LOOSE + NAMED, lambda: F.concat(_one(["AKIA", "ASIA"], 1), _draw(UPPER + DIGITS, 16, 2))),
    "host token": (1, LOOSE + NAMED, lambda: F.concat(_one(["ghp_", "gho_", "ghs_", "npm_"], 1), _draw(ANY, 36, 2))),
    "payment key": (1, LOOSE + NAMED, lambda: F.concat(_one(["sk_live_", "rk_live_", "sk_test_"], 1), _draw(ANY, 24, 2, 34))),
    "service key": (1, LOOSE + NAMED, lambda: F.concat(F.lit("AIza"), _draw(SAFE64, 34, 2), _draw(ANY, 1, 3))),
    "mail key": (1, LOOSE + NAMED, lambda: F.concat(F.lit("SG."), _draw(SAFE64, 21, 2), _draw(ANY, 1, 3), F.lit("."), _draw(SAFE64, 42, 4), _draw(ANY, 1, 5))),
    "signed token": (1, LOOSE + NAMED, lambda: F.concat(F.lit("eyJ"), _draw(ANY, 17, 2, 33), F.lit(".eyJ"), _draw(ANY, 40, 3, 90), F.lit("."), _draw(ANY, 43, 4))),
    "hook token": (1, LOOSE + NAMED, lambda: F.concat(F.lit("xapp-"), _draw(DIGITS, 10, 2, 13), F.lit("-"), _draw(ANY, 24, 4, 32))),
    "bearer": (1, ["Authorization: Bearer ", "-H 'Authorization: Bearer ", "bearer "], lambda: _draw(ANY, 24, 2, 64)),
    "key block": (1, ["-----BEGIN PRIVATE KEY-----\n", "-----BEGIN RSA PRIVATE KEY-----\n"], lambda: F.concat(F.lit("MII"), _draw(BASE64, 60, 2), _draw(ANY, 1, 3))),
    "named hex": (1, NAMED, lambda: F.substr(_draw(HEX, 64, 2), F.lit(1), F.element_at(F.lit([16, 32, 40, 64]), _number(4, 3) + 1))),
    "named code": (1, NAMED, lambda: F.concat(_draw(BASE64, 15, 2, 42), _draw(ANY, 1, 3))),
    "named word": (1, NAMED, lambda: F.concat(F.when(_number(2, 4) == 0, F.initcap(_word(2))).otherwise(_word(2)), _one(["", "!", "@", "#", "_"], 5), _draw(DIGITS, 1, 3, 4))),
    "named phrase": (1, ['password = "', 'secret: "', 'passphrase="'], lambda: F.when(_number(2, 9) == 0, _words(3, " ", 2)).otherwise(F.initcap(_words(2, "", 2)))),
    "chat token": (1, LOOSE + NAMED, lambda: F.concat(_one(["xoxb-", "xoxp-"], 1), _draw(DIGITS, 11, 2, 12), F.lit("-"), _draw(DIGITS, 12, 3), F.lit("-"), _draw(ANY, 24, 4))),
    "lab token": (1, LOOSE + NAMED, lambda: F.concat(F.lit("glpat-"), _draw(SAFE64, 19, 2), _draw(ANY, 1, 3))),
    "plain token": (1, ["Bearer ", "key: ", "X-Key: ", "export KEY="], lambda: _draw(ANY, 32, 2, 48)),
    "commit": (0, ["commit ", "at commit ", "revision ", "merged in ", "fixed by ", "HEAD is now at ", "tree "], lambda: _draw(HEX, 40, 2)),
    "checksum": (0, ["sha256:", "md5 ", "digest: ", "checksum=", "sha1 = ", "etag: ", "hash "], lambda: F.substr(_draw(HEX, 64, 2), F.lit(1), F.element_at(F.lit([32, 40, 64]), _number(3, 3) + 1))),
    "unique id": (0, PLAIN + ["uuid=", "request ", "session "], _uuid),
    "numerals": (0, PLAIN + ["card ", "account ", "call ", "order ", "isbn "], lambda: _draw(DIGITS, 12, 2, 19)),
    "version": (0, PLAIN + ["version ", "requires "], lambda: F.concat(_word(2), _one(["-", "-v", "_"], 3), F.concat_ws(".", *(_draw(DIGITS, 1, 4 + k, 2) for k in range(3))), _one(["", "-beta1", "-rc2", ".tar"], 8))),
    "host": (0, PLAIN + ["https://", "host: ", "ping "], lambda: F.concat(_word(2), _draw(DIGITS, 1, 3, 3), F.lit("."), _word(4), _one([".com", ".org", ".internal", ".net"], 5))),
    "path": (0, PLAIN + ["/", "open ", "file "], lambda: F.concat(_words(3, "/", 2), _draw(DIGITS, 1, 6, 3), _one([".py", ".txt", "", ".html"], 7))),
    "slug": (0, PLAIN + ["/blog/", "post "], lambda: F.concat(_words(2, "-", 2), F.lit("-"), _draw(DIGITS, 1, 5, 4), F.lit("-"), _word(6))),
    "name": (0, PLAIN + ["call ", "def ", "var "], lambda: F.when(_number(2, 7) == 0, F.concat(_word(2), F.initcap(_word(3)), F.initcap(_word(4)), _draw(DIGITS, 1, 5, 3))).otherwise(F.concat(_words(2, "_", 2), F.lit("_"), _draw(DIGITS, 1, 5, 6)))),
    "moment": (0, PLAIN + ["at ", "date: "], lambda: F.concat(F.lit("20"), _draw(DIGITS, 2, 2), _one(["-0", "0"], 3), _draw("123456789", 1, 4), _one(["-1", "1"], 5), _draw(DIGITS, 1, 6), F.lit("T1"), _draw(DIGITS, 5, 7))),
    "coded prose": (0, ["data:text/plain;base64,", "base64 ", "encoded: "], lambda: F.base64(F.encode(_words(6, " ", 2), "UTF-8"))),
    "coded image": (0, ["data:image/png;base64,", "src=data:image/gif;base64,"], lambda: F.concat(_one(["iVBORw0KGgo", "R0lGODlh"], 1), _draw(BASE64, 40, 2, 90), _draw(ANY, 1, 3))),
    "placeholder": (0, NAMED, lambda: _one(["null", "none", "required", "string", "${TOKEN}", "<password>", "xxxxxxxx", "********", "true", "optional"], 2)),
    "sequence": (0, PLAIN, lambda: F.concat(_draw(UPPER, 2, 2, 3), F.lit("_"), _draw(DIGITS, 9, 3, 12))),
    "part number": (0, PLAIN + ["part "], lambda: F.concat(_draw(UPPER, 2, 2), F.lit("-"), _draw(DIGITS, 4, 3), F.lit("-"), _draw(DIGITS, 6, 4))),
    "address": (0, PLAIN + ["mac "], lambda: F.concat_ws("-", *(_draw(HEX, 2, 2 + k) for k in range(6)))),
    "title": (0, PLAIN + ["chapter "], lambda: F.concat(F.initcap(_word(2)), F.lit("_"), F.initcap(_word(3)), F.lit("_"), _draw(DIGITS, 4, 5))),
}

#: forms that stand in no other's place: unknown beginnings, and other numbers and names
HELD_OUT = ("chat token", "lab token", "plain token", "part number", "address", "title")


def known_findings(spark: SparkSession, rows: int = KNOWN_ROWS, forms: Iterable[str] = tuple(FORMS), first: int = 0) -> DataFrame:
    """(nth, run, before, after, label int, form string): findings of about ``rows`` made texts, as many of each form;
    ``first`` is the first one's number, so other numbers give other values. The same arguments give the same rows."""
    forms = list(forms)
    at = F.pmod("i", F.lit(len(forms))).cast("int") + 1
    drawn = spark.range(first, first + rows).withColumnRenamed("id", "i").withColumn("at", at)
    value = F.when(F.lit(False), F.lit(None).cast("string"))
    for n, name in enumerate(forms):
        value = value.when(F.col("at") == n + 1, FORMS[name][2]())
    # options that stand before a value may hold line breaks
    options = F.split(F.element_at(F.split(F.lit("\1".join("\0".join(FORMS[name][1]) for name in forms)), "\1"), F.col("at")), "\0")
    before = F.element_at(options, F.pmod(F.xxhash64("i", F.lit(11)), F.size(options)).cast("int") + 1)
    label = F.element_at(F.lit([FORMS[name][0] for name in forms]), F.col("at"))
    lead = F.when(_number(3, 12) > 0, F.concat(_words(3, " ", 13), F.lit(" "))).otherwise("")
    quote = F.regexp_extract("b", "([\"'])$", 1)
    rest = F.when(_number(2, 17) == 0, F.concat(F.lit(" "), _words(3, " ", 18))).otherwise("")
    form = F.element_at(_list(forms), F.col("at")).alias("form")
    made = drawn.select("i", form, value.alias("value"), before.alias("b"), label.cast("int").alias("label"), lead.alias("lead"), rest.alias("rest"))
    texts = made.select("form", "value", "label", F.concat("lead", "b", "value", quote, "rest").alias("text"))
    return secrets.findings(texts).filter("run = value").select("nth", "run", "before", "after", "label", "form")
