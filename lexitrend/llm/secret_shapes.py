"""Labelled findings for the secret scan: a documented generator of token shapes and of look-alikes.

SHAPES are forms that services document for their tokens (fixed prefixes and lengths, random rest);
LOOK_ALIKES are strings of token characters that are no secrets.  Every generated line is a token or
look-alike between words of ordinary text or in a line of configuration.  A fixed seed makes the
same lines each time.
"""

from __future__ import annotations

import base64
import random
import uuid

_LOW, _UP, _DIG = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ALNUM = _LOW + _UP + _DIG


def _some(r: random.Random, letters: str, n: int) -> str:
    return "".join(r.choices(letters, k=n))


def _jwt(r: random.Random) -> str:
    part = lambda text: base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")
    return ".".join([part('{"alg":"HS256","typ":"JWT"}'), part(f'{{"sub":"{r.randrange(10 ** 9)}","iat":{r.randrange(10 ** 9)}}}'),
                     _some(r, _ALNUM + "-_", 43)])


#: Prefixes and lengths of token forms.
SHAPES = {
    "ghp": lambda r: "ghp_" + _some(r, _ALNUM, 36),
    "gho": lambda r: "gho_" + _some(r, _ALNUM, 36),
    "github_pat": lambda r: f"github_pat_{_some(r, _ALNUM, 22)}_{_some(r, _ALNUM, 59)}",
    "glpat": lambda r: "glpat-" + _some(r, _ALNUM + "-_", 20),
    "npm": lambda r: "npm_" + _some(r, _ALNUM, 36),
    "sk_live": lambda r: "sk_live_" + _some(r, _ALNUM, 24),
    "rk_live": lambda r: "rk_live_" + _some(r, _ALNUM, 24),
    "xoxb": lambda r: f"xoxb-{_some(r, _DIG, 12)}-{_some(r, _DIG, 12)}-{_some(r, _ALNUM, 24)}",
    "AIza": lambda r: "AIza" + _some(r, _ALNUM + "-_", 35),
    "SG": lambda r: f"SG.{_some(r, _ALNUM + '-_', 22)}.{_some(r, _ALNUM + '-_', 43)}",
    "jwt": _jwt,
    "base64_40": lambda r: _some(r, _ALNUM + "+/", 40),
    "base64_64": lambda r: _some(r, _ALNUM + "+/", 64),
    "letters_32": lambda r: _some(r, _LOW + _UP, 32),
    "hex_upper": lambda r: _some(r, _DIG + "ABCDEF", 40),
    "hex_24": lambda r: _some(r, _DIG + "abcdef", 24),
    "alnum_20": lambda r: _some(r, _ALNUM, 20),
}


def _word(r: random.Random, lo: int = 3, hi: int = 9) -> str:
    """A word that can be spoken: consonants and vowels in turn."""
    out, n = "", r.randint(lo, hi)
    while len(out) < n:
        out += r.choice(["b", "c", "d", "f", "g", "l", "m", "n", "p", "r", "s", "t", "v", "st", "tr", "ch", "th"]) + r.choice("aeiou")
        if r.random() < 0.3:
            out += r.choice("nrstlm")
    return out


def _words(r: random.Random, n: int) -> list[str]:
    return [_word(r) for _ in range(n)]


LOOK_ALIKES = {
    "url": lambda r: f"//www.{_word(r)}.{r.choice(['com', 'org', 'net'])}/{'/'.join(_words(r, r.randint(2, 5)))}",
    "page": lambda r: f"{_word(r)}.example.com/page{r.randrange(10 ** 4)}/{'-'.join(_words(r, 3))}.html",
    "path": lambda r: "/" + "/".join(_words(r, r.randint(3, 6))) + r.choice([".py", ".txt", "", ".tar.gz"]),
    "uuid": lambda r: str(uuid.UUID(int=r.getrandbits(128), version=4)),
    "date": lambda r: f"20{r.randrange(10, 30)}-{r.randrange(1, 13):02}-{r.randrange(1, 29):02}T{r.randrange(24):02}.{r.randrange(60):02}.{r.randrange(60):02}",
    "snake": lambda r: "_".join(_words(r, r.randint(3, 5))) + r.choice(["", f"_{r.randrange(100)}"]),
    "constant": lambda r: "_".join(_words(r, r.randint(3, 5))).upper(),
    "camel": lambda r: "".join(w.title() for w in _words(r, r.randint(3, 5))) + r.choice(["", str(r.randrange(100))]),
    "compound": lambda r: "".join(_words(r, r.randint(3, 5))),
    "capitals": lambda r: "".join(_words(r, r.randint(3, 5))).upper() + r.choice(["", "."]),
    "hyphens": lambda r: "-".join(_words(r, r.randint(3, 6))),
    "package": lambda r: ".".join(_words(r, r.randint(3, 5))) + f".{r.randrange(10)}.{r.randrange(20)}",
    "number": lambda r: _some(r, _DIG, r.randint(16, 24)),
    "phone": lambda r: f"+{r.randrange(1, 99)}-{_some(r, _DIG, 3)}-{_some(r, _DIG, 4)}-{_some(r, _DIG, 4)}",
    "rule": lambda r: r.choice("=-_.") * r.randint(16, 70),
    "mail": lambda r: f"{_word(r)}.{_word(r)}.{r.randrange(1900, 2020)}.{_word(r)}.example",
}
_LINES = ["{a} {b} {x} {c} {d}", "{a} {b}: {x}", "{a}_{b} = \"{x}\"", "export {A}_{B}={x}", "Authorization: Bearer {x}", "({x}) {a} {b}",
          "{a}: '{x}', {b}", "{x}\n{a} {b}", "{a}\n{x}\n{b}", "curl -H {x} {a}", "| {a} | {x} | {b} |", "<{x}>, {a}"]


def findings(shapes: dict, n: int, seed: int):
    """(shape, line, start, end) of ``n`` lines of each shape."""
    for name, make in shapes.items():
        r = random.Random(f"{seed}:{name}")
        for _ in range(n):
            x, w = make(r), _words(r, 4)
            line = r.choice(_LINES).format(x="\0", a=w[0], b=w[1], c=w[2], d=w[3], A=w[0].upper(), B=w[1].upper())
            at = line.index("\0")
            yield name, line.replace("\0", x), at, at + len(x)
