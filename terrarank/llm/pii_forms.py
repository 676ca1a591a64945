"""Generated training forms of personal data: written otherwise than the fixed patterns ask, secrets, and look-alikes.

Each form is a piece of text and the part of it that is to be found. They are
set into windows of the corpus at word borders, so the tagger learns them in
the documents' own surroundings. Everything is drawn from one seeded
generator; a form is never taken from the corpus.
"""

from __future__ import annotations

import random

# What a secret is called, and the words that stand for marks in a written-out address.
SECRET_NAMES = ("token", "secret", "api_key", "apikey", "password", "passwd", "access_key", "auth_token", "client_secret", "private_key")
AT_FORMS = (" at ", " (at) ", "(at)", " [at] ", "[at]")
DOT_FORMS = (" dot ", " (dot) ", "(dot)", " [dot] ", "[dot]")
DOMAIN_ENDS = ("com", "org", "net", "de", "fr", "es", "io", "example.com")
HEX, ALNUM = "0123456789abcdef", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def luhn_number(rnd: random.Random, n: int) -> str:
    """Digits whose last one makes the checksum right."""
    d = [rnd.randrange(1, 10), *(rnd.randrange(10) for _ in range(n - 2))]
    doubled = [2 * x - 9 * (x > 4) if i % 2 == 0 else x for i, x in enumerate(reversed(d))]
    return "".join(map(str, d)) + str(-sum(doubled) % 10)


def _word(rnd: random.Random, low: int, high: int) -> str:
    return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(low, high)))


def written_email(rnd: random.Random) -> tuple[str, str]:
    name = _word(rnd, 3, 9) + rnd.choice(["", f".{_word(rnd, 3, 8)}", f".{rnd.randrange(100)}", f"_{rnd.randrange(100)}"])
    host, dot = _word(rnd, 3, 9) + rnd.choice(["", str(rnd.randrange(10))]), rnd.choice(DOT_FORMS)
    end = rnd.choice(DOMAIN_ENDS).replace(".", dot)
    kind = rnd.randrange(3)
    if kind == 0:
        return (f"{name}{rnd.choice(AT_FORMS)}{host}{dot}{end}",) * 2
    if kind == 1:
        return (f"{name}{rnd.choice(AT_FORMS[1:])}{host}.{end.replace(dot, '.')}",) * 2
    return (f"{name} @ {host}{rnd.choice([dot, '.'])}{end}",) * 2


def spaced_ip(rnd: random.Random) -> tuple[str, str]:
    parts = [str(rnd.randrange(1, 256)) for _ in range(4)]
    return (rnd.choice(["[.]", " . ", "(.)", ". ", " dot "]).join(parts),) * 2


def grouped_card(rnd: random.Random) -> tuple[str, str]:
    d = luhn_number(rnd, 16)
    sep = rnd.choice([".", "/", "_", " - ", "  ", "--", "\t"])
    return (sep.join(d[i:i + 4] for i in range(0, 16, 4)),) * 2


def plain_phone(rnd: random.Random) -> tuple[str, str]:
    a, b, c = rnd.randrange(100, 1000), rnd.randrange(100, 1000), rnd.randrange(10_000)
    form = rnd.choice(["({a:03d}) {b}-{c:04d}", "{a:03d}-{b}-{c:04d}", "1 ({a:03d}) {b}-{c:04d}", "001 {a:03d} {b} {c:04d}", "{a:03d}.{b}.{c:04d}",
                       "+1/{a:03d}/{b}/{c:04d}", "1-{a:03d}-{b}-{c:04d}"]).format(a=a, b=b, c=c)
    return form, form


def secret(rnd: random.Random) -> tuple[str, str]:
    size = rnd.choice([24, 32, 40, 48])
    letters = rnd.choice([HEX, HEX, HEX.upper(), ALNUM, ALNUM[:36]])
    value = "".join(rnd.choice(letters) for _ in range(size))
    value = value[:4] + str(rnd.randrange(10)) + rnd.choice(letters[10:16]) + value[6:]
    quote = rnd.choice(['"', '"', "'", ""])
    name = rnd.choice(SECRET_NAMES)
    return f"{name if rnd.random() < 0.8 else name.upper()}{rnd.choice([' = ', '=', ': ', ':'])}{quote}{value}{quote}", value


def look_alike(rnd: random.Random) -> tuple[str, str]:
    """Numbers that are nobody's data; nothing in them is to be found."""
    made = [f"{rnd.randrange(1900, 2030)}-{rnd.randrange(1, 13):02d}-{rnd.randrange(1, 29):02d}", f"{rnd.randrange(24)}:{rnd.randrange(60):02d}",
            f"{rnd.randrange(10_000)}.{rnd.randrange(100):02d}", "".join(rnd.choice("0123456789") for _ in range(rnd.randrange(3, 8))),
            f"v{rnd.randrange(9)}.{rnd.randrange(20)}.{rnd.randrange(20)}", f"{rnd.randrange(1, 400)}-{rnd.randrange(400, 900)}",
            f"@{_word(rnd, 4, 10)}", f"{_word(rnd, 2, 6)}{rnd.randrange(100)}", f"{rnd.randrange(100)} %", f"dot {_word(rnd, 3, 7)}",
            "".join(rnd.choice("0123456789") for _ in range(rnd.randrange(22, 40)))]
    return rnd.choice(made), ""


#: Kind of each generator; look-alikes have none.
FORMS = (("email", written_email), ("ip", spaced_ip), ("card", grouped_card), ("phone", plain_phone), ("secret", secret), (None, look_alike))


def placed(piece: str, spans: list[tuple[str, int, int]], kind: str | None, form: tuple[str, str], rnd: random.Random,
           size: int) -> tuple[str, list[tuple[str, int, int]]] | None:
    """The window with the form set in at a word border outside its spans, cut to ``size`` characters around the form."""
    text, found = form
    borders = [i for i, c in enumerate(piece) if c == " " and all(i < a or i >= b for _, a, b in spans)]
    if not borders or len(text) + 2 > size:
        return None
    at = rnd.choice(borders) + 1
    # sometimes a number of its own stands beside it
    before, after = (f"{rnd.randrange(100)} " if rnd.random() < 0.3 else "", f" {rnd.randrange(1000)}" if rnd.random() < 0.15 else "")
    shift = len(before)
    text = f"{before}{text}{after}"
    if len(text) + 2 > size:
        return None
    whole = f"{piece[:at]}{text} {piece[at:]}"
    moved = [(k, a, b) if b <= at else (k, a + len(text) + 1, b + len(text) + 1) for k, a, b in spans]
    if kind is not None:
        start = at + shift + text[shift:].index(found)
        moved.append((kind, start, start + len(found)))
    # the form with what stands around it
    room = size - len(text)
    start = max(0, min(at - rnd.randrange(room + 1), len(whole) - size))
    end = start + size
    if any(a < start < b or a < end < b for _, a, b in moved):
        return None
    return whole[start:end], [(k, a - start, b - start) for k, a, b in moved if start <= a and b <= end]
