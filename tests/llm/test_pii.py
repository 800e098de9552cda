"""Personal data: base spans against the patterns themselves, and planted disguises."""

import hashlib
import random
import re
import time

import pyarrow as pa
import pytest
from corpus import collected, documents, empty, odd_documents, odd_rows, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

from postlark.llm import pii

# The patterns as they are stated, with backtracking.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def stated(text):
    out = {}
    for kind, pattern in STATED.items():
        out[kind] = []
        for found in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", found.group())
            if kind == "ip":
                fits = all(int(part) <= 255 for part in found.group().split("."))
            elif kind == "card":
                fits = 13 <= len(digits) <= 19 and luhn(digits)
            else:
                fits = kind == "email" or 9 <= len(digits) <= 15
            if fits:
                out[kind].append(found.span())
    return out




@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@-+ 0159(%é\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.plain_spans(text) == stated(text)


def test_base_spans_of_numbers():
    rng = random.Random(3)
    for _ in range(3000):
        marks = rng.choice([" ", "-", ".", "", "  ", "+", "1"])
        text = marks.join(str(rng.randrange(10 ** rng.randint(1, 6))) for _ in range(rng.randint(1, 9)))
        text = rng.choice(["", "+", "x"]) + text + rng.choice(["", ".", " "])
        assert pii.plain_spans(text) == stated(text), text


@settings(max_examples=600, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            "one two zéro ONE dot DOT (dot) [.] at AT (at) @ arroba _at_ _dot_ 1 12 255 a b.c com + plus "
            "double &#64; &#46; . , - é ß х １ ( ) x_".split()
            + [" ", "  ", "\t", "\n", ", "]
        ),
        max_size=14,
    ).map("".join)
)
def test_marks_let_pass_what_is_found(text):
    base, added = pii.all_spans(text)
    (searches,) = pii.marked(pa.array([text]))
    assert pii.all_spans(text, searches) == (base, added)


WORDS = "zero one two three four five six seven eight nine".split()
GERMAN = "null eins zwei drei vier fünf sechs sieben acht neun".split()


def valid_card(rng):
    body = "".join(rng.choice("0123456789") for _ in range(15))
    return next(body + d for d in "0123456789" if luhn(body + d))


def disguises(rng):
    """A disguised identifier and its kind."""
    name = f"{rng.choice(['ann', 'bo', 'eve'])}.{rng.randrange(90)}"
    host = [f"mail{rng.randrange(9)}", "example", rng.choice(["com", "org"])]
    at = rng.choice([" (at) ", " [at] ", "(at)", " at ", " AT ", "[AT]", " {at} ", "&#64;"])
    dot = rng.choice([" dot ", " (dot) ", "[dot]", " [.] ", " DOT ", "(.)"])
    card = valid_card(rng)
    spell = rng.choice([WORDS, GERMAN])
    gap = rng.choice([" ", "-", ", "])
    parts = [str(rng.randrange(256)) for _ in range(4)]
    phone = "".join(rng.choice("0123456789") for _ in range(10))
    wide = str.maketrans({c: chr(ord(c) + 0xFEE0) for c in "0123456789@."})
    cyrillic = str.maketrans("aeopc", "аеорс")
    return rng.choice(
        [
            ("email", name + at + dot.join(host)),
            ("email", name + rng.choice([" (at) ", "[at]", " at "]) + ".".join(host)),
            ("email", name.replace(".", " dot ") + "@" + ".".join(host)),
            ("email", f"{name}@{'.'.join(host)}".translate(cyrillic)),
            ("email", f"{name}@{'.'.join(host)}".translate(wide)),
            ("card", gap.join(spell[int(d)] for d in card)),
            ("card", card[:8] + " " + " ".join(WORDS[int(d)] for d in card[8:])),
            ("card", card.translate(wide)),
            ("card", "​".join(card)),
            ("ip", " dot ".join(parts)),
            ("ip", "[.]".join(parts)),
            ("ip", " dot ".join(" ".join(WORDS[int(d)] for d in p) for p in parts)),
            ("phone", "plus one " + " ".join(WORDS[int(d)] for d in phone)),
            ("phone", f"+1 ({phone[:3]}) " + " ".join(WORDS[int(d)] for d in phone[3:])),
            ("phone", f"+1 ({phone[:3]}) {phone[3:6]}-{phone[6:]}".translate(wide)),
        ]
    )


PROSE = "the of und en la mail was at at dots the one of them that were ç é per two".split()


def test_disguises_are_found_at_their_place():
    rng = random.Random(11)
    for _ in range(4000):
        kind, own = disguises(rng)
        before = " ".join(rng.choice(["wen", "la", "é", "thon"]) for _ in range(rng.randint(0, 5)))
        after = rng.choice([". Then", " thon of", "\nnext", ", la"])
        text = f"{before}: {own}{after}"
        base, added = pii.all_spans(text)
        assert base == stated(text)
        assert pii.all_spans(text, pii.marked(pa.array([text]))[0]) == (base, added)
        start = len(before) + 2
        assert (start, start + len(own)) in added[kind], (text, added)
        assert sum(map(len, added.values())) == 1, (text, added)


def test_prose_is_left_alone():
    rng = random.Random(12)
    for _ in range(2000):
        text = " ".join(rng.choice(PROSE) for _ in range(30))
        assert not any(pii.added_spans(text, pii.plain_spans(text)).values()), text
    for text in (
        "Meet me at example.com now.",
        "He was at home.Then he left.",
        "one two three four five six seven eight nine ten",
        "3 @ 5.99 each",
        "Version 2.0 at 10.5",
        "русский текст 12 и ещё",
        "double one, triple two",
        "an @ sign and a dot com",
    ):
        assert not any(pii.added_spans(text, pii.plain_spans(text)).values()), text


def test_base_spans_stay():
    text = "mail john dot smith@mail.com or a@b.co at 1.2.3.4"
    base, added = pii.all_spans(text)
    assert [text[a:b] for a, b in base["email"]] == ["smith@mail.com", "a@b.co"]
    assert [text[a:b] for a, b in added["email"]] == ["john dot smith@mail.com"]
    assert pii.written({**base, "email": base["email"] + added["email"]}) == (
        "email:5:28,email:14:28,email:32:38,ip:42:49"
    )


def test_rewritten_maps_back():
    way = pii.Rewritten("abcdefgh", [(1, 3, "XYZ"), (4, 5, ""), (7, 8, "W")])
    assert way.text == "aXYZdfgW"
    assert way.back((0, 1)) == (0, 1)
    assert way.back((1, 4)) == way.back((2, 3)) == (1, 3)
    assert way.back((4, 6)) == (3, 6)
    assert way.back((0, 8)) == (0, 8)


@pytest.mark.parametrize(
    "part",
    "x 1 . @ + ( at one 1. +1 a@ a. (at) [.] é- @a. dot".split()
    + [" dot ", "one ", "at ", "1 ", "a b@", "one dot ", "+1 (", "a dot "],
)
def test_long_runs_take_linear_time(part):
    text = part * (300_000 // len(part))
    started = time.perf_counter()
    pii.all_spans(text)
    assert time.perf_counter() - started < 10


def expected(rows):
    out = []
    for key, text in rows:
        base = stated(text or "") if len(text or "") < 90_000 else pii.plain_spans(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, own in base.items() for a, b in own)
        hashed = hashlib.sha256(listed.encode()).hexdigest()
        out.append((key, *[len(own) for own in base.values()], hashed, listed, 0))
    return sorted(out, key=repr)


def test_table(spark):
    rows = [
        (1, "a@b.co and c@d.e.f, 10.0.0.256 or 10.0.0.25"),
        (2, "4041894974608795 4041 8949 7460 8795, 4041894974608796"),
        (3, "+1 (988) 555-2485 +12"),
    ] + [row[:2] for row in odd_rows()]
    assert collected(pii.personal_data(documents(spark, rows))) == expected(rows)


def test_odd_input(spark):
    plain = collected(pii.personal_data(odd_documents(spark)))
    assert plain == collected(pii.personal_data(with_clashes(odd_documents(spark))))
    assert collected(pii.personal_data(empty(spark))) == []
    none = hashlib.sha256(b"").hexdigest()
    assert collected(pii.personal_data(documents(spark, [(1, None), (2, "")]))) == [
        (n, 0, 0, 0, 0, none, "", 0) for n in (1, 2)
    ]


def test_given_documents(spark, data):
    """Every base span of the given table, and nothing besides, as it has no disguises."""
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    rows = [tuple(row) for row in docs.collect()]
    assert collected(pii.personal_data(docs)) == expected(rows)
