"""Golden cases of the nine detectors, then a comparison with plain walks over characters on hostile texts."""

import random
import string

import pytest
from pyspark.sql import functions as F

from veiltext.functions import detect as D

GOLDEN = [
    ("EMAIL", "Ask lena@firm.test or write later", ["lena@firm.test"]),
    ("EMAIL", "cc: k.moor@post.dept.firm.co.nz", ["k.moor@post.dept.firm.co.nz"]),
    ("EMAIL", "list+spring@club.example", ["list+spring@club.example"]),
    ("EMAIL", "at @ sign, no host: lena@, no name: @firm", []),
    ("EMAIL", "p@q.nl;r@s.be", ["p@q.nl", "r@s.be"]),
    ("EMAIL", "from=lena@firm.test", ["lena@firm.test"]),
    ("EMAIL", "ends with lena@firm.test\n", ["lena@firm.test"]),
    ("EMAIL", "p@q.nl!r@s.be p@q.nl@s.be", ["p@q.nl", "r@s.be", "p@q.nl"]),
    ("EMAIL", "m@.q.nl m@q..k.nl m@..q.nl m@q...k.nl", ["m@.q.nl", "m@q..k.nl"]),
    ("EMAIL", "p@q.nl.z9 w@q.nlx9", ["p@q.nl", "w@q.nlx"]),
    ("PHONE", "ring 212-867-0199, thanks", ["212-867-0199"]),
    ("PHONE", "desk (212) 867-0199", ["(212) 867-0199"]),
    ("PHONE", "mobile +1-212-867-0199!", ["+1-212-867-0199"]),
    ("PHONE", "office +31 20 4455 6677", ["+31 20 4455 6677"]),
    ("PHONE", "item 86701", []),
    ("PHONE", "wide 212\u00a0867\u00a00199", ["212\u00a0867\u00a00199"]),
    ("PHONE", "212-867-0199 212-867-0142", ["212-867-0199", "212-867-0142"]),
    ("SSN", "number 219-09-9731", ["219-09-9731"]),
    ("SSN", "number 219099731,", ["219099731"]),
    ("SSN", "no area 000-09-9731, 666-09-9731", []),
    ("SSN", "no group 219-00-9731", []),
    ("SSN", "no serial 219-09-0000", []),
    ("SSN", "high area 951-09-9731", ["951-09-9731"]),
    ("CREDIT_CARD", "paid by 4012888888881881", ["4012888888881881"]),
    ("CREDIT_CARD", "paid by 5105105105105100", ["5105105105105100"]),
    ("CREDIT_CARD", "paid by 371449635398431", ["371449635398431"]),
    ("CREDIT_CARD", "4012-8888-8888-1881", ["4012-8888-8888-1881"]),
    ("CREDIT_CARD", "5105 1051 0510 5100", ["5105 1051 0510 5100"]),
    ("CREDIT_CARD", "3714 496353 98431", ["3714 496353 98431"]),
    ("SECRET", "app-secret=Zq81-kk20x; passwd: 'moonlight7'", ["app-secret=Zq81-kk20x", "passwd: 'moonlight7'"]),
    ("TOKEN", "authorization: Bearer q8s7d6f5g4 refresh_token=0011223344", ["authorization: Bearer q8s7d6f5g4", "refresh_token=0011223344"]),
    ("IP_ADDRESS", "node 172.20.14.9 is back", ["172.20.14.9"]),
    ("IP_ADDRESS", "0.0.0.0/255.255.255.255", ["0.0.0.0", "255.255.255.255"]),
    ("IP_ADDRESS", "302.20.14.9 and 720.720.720.720", []),
    ("DATE", "since 11/30/1987", ["11/30/1987"]),
    ("DATE", "since 2019-07-04", ["2019-07-04"]),
    ("DATE", "since February 9, 2011", ["February 9, 2011"]),
    ("DATE", "since oct 31, 1999", ["oct 31, 1999"]),
    ("DATE", "since 11-30-87", ["11-30-87"]),
    ("ZIP_CODE", "to 02139", ["02139"]),
    ("ZIP_CODE", "to 02139-4301", ["02139-4301"]),
    ("ZIP_CODE", "\u00e902139", ["02139"]),
    ("ZIP_CODE", "v02139 02139_", []),
]

# A second reading of the rules, as walks over characters. A walk takes a text and a place and yields
# the places where it may end, the preferred one first.
BLANKS = "\t\n\x0b\f\r \u00a0\u1680\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(map(chr, range(0x2000, 0x200B)))
LETTERS = string.ascii_letters
WORD = LETTERS + string.digits + "_"


def one(chars):
    def walk(t, i):
        if i < len(t) and t[i] in chars:
            yield i + 1

    return walk


def word(name):
    def walk(t, i):
        if t[i : i + len(name)].lower() == name and t[i : i + len(name)].isascii():
            yield i + len(name)

    return walk


def run(chars, least, most=None):
    """As many of these characters as there are, then fewer."""

    def walk(t, i):
        end = i
        while end < len(t) and t[end] in chars and (most is None or end - i < most):
            end += 1
        yield from range(end, i + least - 1, -1)

    return walk


def digits(n):
    return run(string.digits, n, n)


def then(*walks):
    def walk(t, i, rest=walks):
        if not rest:
            yield i
            return
        for end in rest[0](t, i):
            yield from walk(t, end, rest[1:])

    return walk


def either(*walks):
    def walk(t, i):
        for w in walks:
            yield from w(t, i)

    return walk


def maybe(w):
    return either(w, then())


def number(low, high, widths):
    """A decimal number within bounds, written with one of these numbers of digits."""

    def walk(t, i):
        for n in widths:
            part = t[i : i + n]
            if len(part) == n and all(c in string.digits for c in part) and low <= int(part) <= high:
                yield i + n

    return walk


def octet(t, i):
    yield from number(100, 255, (3,))(t, i)
    yield from number(0, 99, (2, 1))(t, i)


def host(t, i):
    """The longest name of labels with a dot or two between them (one before them allowed) and a last part of letters."""
    end = i
    while end < len(t) and t[end] in WORD[:-1] + ".-":
        end += 1
    for stop in range(end, i, -1):
        head, dot, last = t[i:stop].rpartition(".")
        if not dot or len(last) < 2 or any(c not in LETTERS for c in last) or t[stop : stop + 1] in tuple(LETTERS):
            continue
        labels = head.removeprefix(".")
        if labels and not labels.startswith(".") and not labels.endswith(".") and "..." not in head:
            yield stop
            return


def email(t, i):
    name = 0
    while i + name < len(t) and t[i + name] in LETTERS + "_" and name < 21:
        name += 1
    named = any(t[i + n : i + n + 1] == "=" for n in range(2, min(name, 20) + 1))
    if t[i] not in ".'?" and not named:
        local = WORD + "!#$%&'*+-/=?^`{|}~."
        yield from then(one(local), run(local, 0), one("@"), host)(t, i)


def keyed(names, extra=None):
    value = run(WORD + ".~+/=-", 8)
    mark = then(run(BLANKS, 0), one(":="), run(BLANKS, 0), maybe(one("\"'")))
    keys = either(*(then(*[w for part in n.split(" ") for w in (maybe(one("_-")), word(part))][1:]) for n in names))
    return then(keys, mark, maybe(extra) if extra else then(), value, maybe(one("\"'")))


def groups(starts, *sizes):
    """Digits that begin in one of these ways, in groups that a dash or blank may divide."""
    first = either(*(then(*map(word, [s]), digits(sizes[0] - len(s))) for s in starts))
    rest = [w for n in sizes[1:] for w in (maybe(one("-" + BLANKS)), digits(n))]
    return then(first, *rest)


def not_valid_ssn(value):
    plain = value.replace("-", "")
    return plain[:3] in ("000", "666") or plain[3:5] == "00" or plain[5:] == "0000"


def ssn(t, i):
    for w in (then(digits(3), one("-"), digits(2), one("-"), digits(4)), digits(9)):
        for end in w(t, i):
            if not not_valid_ssn(t[i:end]):
                yield end


SEP = maybe(one("-." + BLANKS))
MASTER = [f"5{n}" for n in range(1, 6)]
AMEX = ["34", "37"]
DAY = number(1, 31, (2, 1))
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
NAMES = MONTHS + ["sept"] + [m[:3] for m in MONTHS]
# label -> walk, characters that may not stand before, characters that may not follow
WALKS = {
    "EMAIL": (email, WORD + ".%+-@", ""),
    "PHONE": (
        either(
            then(maybe(then(maybe(one("+")), one("1"), SEP)), either(then(one("("), digits(3), one(")")), digits(3)), SEP, digits(3), SEP, digits(4)),
            then(one("+"), run(string.digits, 1, 3), SEP, run(string.digits, 1, 4), *[SEP, run(string.digits, 2, 4)] * 2, maybe(then(SEP, run(string.digits, 2, 4)))),
        ),
        WORD[:-1],
        WORD[:-1] + "-",
    ),
    "SSN": (ssn, string.digits, string.digits),
    "CREDIT_CARD": (
        either(
            then(one("4"), digits(12), maybe(digits(3))), groups(MASTER, 16), groups(AMEX, 15),
            groups(["4", *MASTER, *AMEX], 4, 4, 4, 4), groups(AMEX, 4, 6, 5),
        ),
        WORD,
        WORD,
    ),
    "SECRET": (keyed(["secret", "client secret", "app secret", "password", "passwd", "pwd", "private key"]), WORD, ""),
    "TOKEN": (
        keyed(["token", "access token", "refresh token", "api key", "authorization"], then(word("bearer"), run(BLANKS, 1))),
        WORD,
        "",
    ),
    "IP_ADDRESS": (then(octet, one("."), octet, one("."), octet, one("."), octet), WORD, WORD),
    "DATE": (
        either(
            then(number(1, 12, (2, 1)), one("/-"), DAY, one("/-"), either(digits(2), digits(4))),
            then(digits(4), one("-"), number(1, 12, (2, 1)), one("-"), DAY),
            then(either(*map(word, NAMES)), run(BLANKS, 1), DAY, one(","), run(BLANKS, 1), either(word("19"), word("20")), digits(2)),
        ),
        WORD,
        WORD,
    ),
    "ZIP_CODE": (then(digits(5), maybe(then(one("-"), digits(4)))), WORD, WORD),
}


def expected_spans(text):
    out = []
    for rank, (label, (walk, before, after)) in enumerate(WALKS.items()):
        i = 0
        while i < len(text):
            end = None
            if i == 0 or text[i - 1] not in before:
                end = next((e for e in walk(text, i) if e == len(text) or text[e] not in after), None)
            if end is None:
                i += 1
            else:
                out.append((i, end, rank, label, text[i:end]))
                i = end
    out.sort()
    return [(label, s, e, value) for s, e, _, label, value in out]


def test_walks_agree_with_golden():
    for label, text, want in GOLDEN:
        assert [v for name, _, _, v in expected_spans(text) if name == label] == want, (label, text)


def test_golden(spark):
    df = spark.createDataFrame(
        [(i, label, text) for i, (label, text, _) in enumerate(GOLDEN)], "i int, label string, text string"
    )
    rows = df.withColumn("es", D.detect_structured("text")).collect()
    for r in rows:
        label, text, want = GOLDEN[r.i]
        got = [e.text for e in r.es if e.label == label]
        assert got == want, (label, text, got)
        for e in r.es:
            assert text[e.start_pos : e.end_pos] == e.text


@pytest.mark.parametrize("label", list(WALKS))
def test_single_detector_equals_structured(spark, label):
    df = spark.createDataFrame([(t,) for _, t, _ in GOLDEN], "text string")
    one = D.detect("text", label)
    all_ = F.filter(D.detect_structured("text"), lambda e: e["label"] == label)
    assert df.filter(one != all_).count() == 0


def test_clean_and_empty(spark):
    df = spark.createDataFrame(
        [("The quick brown fox jumps over the lazy dog.",), ("",)], "text string"
    )
    assert [r.n for r in df.select(F.size(D.detect_structured("text")).alias("n")).collect()] == [0, 0]


ATOMS = [
    "a@b.com", "user.name+tag@mail.example.co.uk", "x=", "email=", "@", "@@", "..", ".", "!", "'", "?",
    "555-123-4567", "(555) 123-4567", "+44 20 7946 0958", "+1", "123-45-6789", "123456789", "000-12-3456",
    "4111111111111111", "3782 822463 10005", "password: ", "token=", "Bearer ", "abcDEF123456", "api_key:",
    "192.168.1.1", "256.1.2.3", "01/15/1990", "2024-03-15", "Jan 5, 2023", "90210", "90210-1234", " ", " ", " ",
    "\n", "\u00a0", "\u00e9", "\U0001f600", "_", "-", "\"", "joe", "\uffff", "1", "42", "\u2028", ",", "secret", "=",
]


def test_random_texts_equal_walks(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(ATOMS) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(4)
    for r in df.withColumn("es", D.detect_structured("text")).collect():
        got = [(e.label, e.start_pos, e.end_pos, e.text) for e in r.es]
        assert got == expected_spans(r.text), r.text


def test_long_and_hostile_texts(spark):
    """Texts on which a backtracking search overflows its stack or takes minutes."""
    texts = [
        "x@" + "a." * 200_000 + "com",
        "!" * 300_000 + "@",
        "!" * 300_000 + " joe@x.org",
        "/ab" * 100_000 + "@q 90210",
        "=" * 200_000 + "\npassword" + " " * 100_000 + ":",
        "@" * 20_000 + " joe@x.org",
        " ".join(f"u{i}@x.org 10.0.0.{i % 256}" for i in range(30_000)),
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    es = D.detect_structured("text")
    got = {r.i: len(r.es) for r in df.select("i", es.alias("es")).collect()}
    assert got == {0: 1, 1: 0, 2: 1, 3: 1, 4: 0, 5: 1, 6: 60_000}
