"""Surrogates for personal data.

Entities of many kinds are found in whole texts and replaced by keyed surrogates
of the same kind and format.  Kinds written in digits and letters are encrypted
within their own format (a Feistel network over the mixed radix of their
symbols), a bijection: distinct entities stay distinct, the same entity gets the
same surrogate everywhere, however it is spaced.  Numbers with check digits
count only where these hold, and hold afterwards.  Names are replaced word by
word: a family name by an invented one, the same in every mention; a listed given
name by another of its gender and script, permuted for each family; other given
names and street names by invented ones.  As invented words could meet each other
or a word that the corpus has, those of the whole corpus are checked and drawn
again until none do.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import ipaddress
import math
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged, with_group

#: Given names by script and gender, u where it is open; a surrogate comes from the list that the name stands in.
#: A deployment adds names of its own as `more_names`.
GIVEN = {
    ("latin", "f"): "Anna Maria Sophie Emma Laura Julia Claire Elena Lucia Carmen Ingrid Helga Alice Martha Louise Camille Sarah Jessica Emily Elizabeth Jennifer Susan Karen Linda Patricia Barbara Priya Fatima Aisha Mei Yuki Ana Isabel Sofía Chloé Hannah Katharina Sabine".split(),
    ("latin", "m"): "John Peter Thomas Martin Daniel Robert Pierre Michel Carlos Miguel Hans Jürgen Walter Henri Pablo Oscar David Michael James William Richard Joseph Charles Matthew Andrew Paul Wei Raj Mohammed Ahmed Hiroshi José Juan Luis François Stefan Wolfgang Antonio".split(),
    ("latin", "u"): "Alex Robin Kim Chris Jamie Taylor Jordan Casey Morgan Riley Quinn Avery".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Ирина Татьяна Наталья Светлана".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Андрей Николай Дмитрий Михаил Павел".split(),
    ("cyrillic", "u"): "Саша Женя Валя Шура".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Αγγελική Γεωργία".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Κώστας Νίκος Παναγιώτης Χρήστος".split(),
    ("greek", "u"): "Άλεξ Κρις".split(),
}
#: Syllables of invented words, and the ending of family names by gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke la le lo ma me mo na ne no pa pe ra re ro sa se ta te va ve".split(),
    "cyrillic": "ба бе бо да де до за ка ке ла ле ло ма ме мо на не но па пе ра ре ро са се та те то ва ве во га".split(),
    "greek": "βα βε βο δα δε δο κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε το φα φο".split(),
}
ENDINGS = {("cyrillic", "f"): "ова", ("cyrillic", "m"): "ов", ("greek", "f"): "ίδου", ("greek", "m"): "ίδης"}
TITLES = {"f": "Mrs Ms Miss Frau Mme Madame Mademoiselle Sra Señora".split(), "m": "Mr Herr Monsieur Sr Señor Sir".split(), "u": "Dr Prof Professor Doctor Doktor Docteur Mx".split()}
#: Words before a name, and after it, that tell it even if no list has it.
BEFORE = ("my name is", "name:", "named", "signed by", "contact:", "contact person:", "author:", "dear", "mein name ist", "ich heiße", "je m'appelle", "je m’appelle", "me llamo", "mi nombre es", "меня зовут", "με λένε", "kind regards,", "best regards,", "mit freundlichen grüßen", "cordialement,", "saludos,")
AFTER = "said says wrote writes replied asked told called lives works".split()
#: What stands before and after the name of a street.
STREETS = (
    r"\b(?P<n>\d{1,5}) (?P<v>(?:\p{Lu}[\p{L}'.-]* ){0,2}\p{Lu}[\p{L}'-]+) (?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Court)\b",
    r"\b(?P<v>\p{Lu}\p{L}{2,}?)(?:straße|strasse|str\.|weg|platz|gasse|allee) (?P<n>\d{1,4})\b",
    r"\b(?P<n>\d{1,4}),? (?:rue|avenue|boulevard|place|chemin|impasse) (?:de la |de l['’]|du |des |de |d['’])?(?P<v>\p{Lu}[\p{L}'-]+)",
    r"\b(?:Calle|Avenida|Plaza|Paseo) (?:de la |del |de )?(?P<v>\p{Lu}[\p{L}'-]+),? (?P<n>\d{1,4})\b",
)
#: One of these is in every text that holds a street; one of the next in every secret told by a word.
STREET_WORDS = (" street", " st", " avenue", " ave", " road", " rd", " lane", " ln", " drive", " boulevard", " blvd", " court", "straße", "strasse", "str.", "weg ", "platz ", "gasse ", "allee ", "rue ", "place ", "chemin ", "impasse ", "avenue ", "boulevard ", "calle ", "avenida ", "plaza ", "paseo ")
SECRET_WORDS = ("token", "secret", "password", "passwd", "pwd", "api", "access")
# Calling codes of two digits; 1 and 7 are codes of one, all others of three.
TWO_DIGIT_CODES = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
#: Fixed beginnings of secrets, which their surrogates keep.
KEY_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "sk-", "xoxb-", "xoxa-", "xoxp-", "xoxr-", "xoxs-", "AIza", "eyJ")

_GENDER = {n.casefold(): k for k, names in GIVEN.items() for n in names}
_POOL = {k: {n.casefold(): i for i, n in enumerate(names)} for k, names in GIVEN.items()}
_TITLE = {t.casefold(): g for g, ts in TITLES.items() for t in ts}

_DATE = r"\d{4}-\d{1,2}-\d{1,2}|\d{1,2}[./-]\d{1,2}[./-](?:19|20)\d{2}"
_CUE_PHONE = r"(?i:\b(?:tel|telephone|phone|mobile|cell|call|fax|whatsapp|telefon|handy|mobil|tél|téléphone|teléfono|móvil)\b)[.:]*\s?"
_DIGITS = r"(?:\(\d{1,5}\)|\d)(?:[ ./-]{0,2}(?:\(\d{1,5}\)|\d)){6,17}+"
#: In this order; a later kind doesn't touch what an earlier one took.
PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]++@[A-Za-z0-9](?:[A-Za-z0-9-]*\.)+[A-Za-z]{2,}",
    "secret": r"(?i:\b(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key)\b[\"']?\s*[=:]\s*[\"']?)(?P<v>[A-Za-z0-9+/_=-]{8,})"
    r"|(?<![\w-])(?P<v>eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,}|(?:sk-|xox[abprs]-|glpat-|AIza|github_pat_)[\w-]{16,}+)(?![\w-])"
    r"|\b(?P<v>(?=[0-9a-fA-F]*\d)(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{32,}|A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,})\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "ipv6": r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])",
    "mac": r"\b[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}\b",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "birth": rf"(?i:\b(?:born(?: on)?|dob|date of birth|geboren(?: am)?|geb|geburtsdatum|née?(?: le)?|date de naissance|nacid[oa](?: el)?|fecha de nacimiento)\b)[.:]*\s?(?P<v>{_DATE})(?!\d)",
    "card": r"(?<![\d.])(?:\d{13,19}|\d{4}(?P<s>[ -])\d{4}(?P=s)\d{4}(?P=s)\d{1,4}(?:(?P=s)\d{1,3})?|\d{4}(?P<t>[ -])\d{6}(?P=t)\d{5})(?!\d)",
    "phone": rf"(?<![\w.+])(?P<v>\+[ ]?{_DIGITS})(?!\w)|(?<![\w.,+-])(?P<v>00[1-9]\d{{0,2}}[ ./-]{_DIGITS})(?!\w)|{_CUE_PHONE}(?P<v>{_DIGITS})(?!\w)"
    r"|(?<![\w.])(?P<v>\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[ .-]\d{3,4}[ .-]\d{4})(?!\w)",
}
_FOUND = {k: regex.compile(p) for k, p in PATTERNS.items()}
_WORD = r"\p{Lu}[\p{L}'’-]*\p{L}"
_NAME = regex.compile(rf"\b(\p{{Lu}}[\p{{L}}]+)\.? ({_WORD})(?: ({_WORD}))?")
#: Words in lower case that stand inside a name, before its last word.
PARTICLES = "von van de del della di da do dos du der den la le ter zu zur al bin ben el".split()
_GAP = r"[ \t\u00a0]{1,3}"
_NEXT = regex.compile(rf"{_GAP}(\p{{Lu}}\.(?=\s)|{_WORD})")
_PARTICLE = regex.compile(rf"{_GAP}(?:{'|'.join(PARTICLES)})(?=\s)")
_CAPITAL = regex.compile(rf"\b{_WORD}")
_TURNED = regex.compile(rf"\b({_WORD}),{_GAP}(\p{{Lu}}\p{{L}}+)\b")
_AFTER_CUE = regex.compile(rf"(?i:(?<!\w)(?:{'|'.join(map(regex.escape, BEFORE))}))\s+({_WORD}) ({_WORD})")
_BEFORE_CUE = regex.compile(rf"\b({_WORD}) ({_WORD}) (?:{'|'.join(AFTER)})\b")
_STREETS = [regex.compile(p) for p in STREETS]
_DIGIT = regex.compile(r"\d")


class NameLists:
    """Given names (case-folded) to their script and gender: the lists above and a deployment's own.

    seen() tells in one pass of Aho-Corasick which patterns a text may need at all.
    """

    def __init__(self, more: dict[tuple[str, str], list[str]] | None = None):
        self.names = _GENDER | {n.casefold(): k for k, names in (more or {}).items() for n in names}
        self._found = None

    def get(self, name: str, default=None):
        return self.names.get(name.casefold(), default)

    def __getstate__(self) -> dict:
        return {"names": self.names, "_found": None}  # each worker builds its own automaton

    def _automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        words = {w.casefold(): ("name", len(w.casefold())) for w in (*self.names, *_TITLE)}
        for kind, terms in (("after", BEFORE), ("before", [f" {w}" for w in AFTER]), ("street", STREET_WORDS), ("secret", SECRET_WORDS), ("secret", KEY_PREFIXES)):
            for w in terms:
                words.setdefault(w.casefold(), (kind, 0))
        for w, value in words.items():
            out.add_word(w, value)
        out.make_automaton()
        return out

    def seen(self, text: str) -> set[str]:
        if self._found is None:
            self._found = self._automaton()
        low, out = text.casefold(), set()
        for end, (kind, whole) in self._found.iter(low):
            if whole and kind not in out and (low[end - whole : end - whole + 1].isalpha() and end >= whole or low[end + 1 : end + 2].isalpha()):
                continue  # a name inside a longer word
            out.add(kind)
        return out


def luhn(digits: list[int]) -> int:
    """The check digit that completes `digits`."""
    total = sum(d if i % 2 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits)))
    return -total % 10


def scripts_of(word: str) -> str:
    c = ord(word[0])
    return "greek" if 0x370 <= c < 0x400 else "cyrillic" if 0x400 <= c < 0x530 else "latin"


#: The lists above alone.
LISTED = NameLists()


@dataclass
class Name:
    start: int
    end: int
    given: str | None
    family: str
    gender: str
    script: str
    #: The span is that of the given name alone.
    given_only: bool = False

    @property
    def family_token(self) -> str:
        """What the new family name depends on: where its form tells the gender, that too."""
        return f"family|{self.script}|{self.gender if (self.script, self.gender) in ENDINGS else ''}|{self.family.casefold()}"

    @property
    def given_token(self) -> str:
        return f"given|{self.script}|{self.gender}|{(self.given or '').casefold()}"

    @property
    def tokens(self) -> list[str]:
        """What invented words stand for in the new name."""
        return [self.family_token, *([self.given_token] if self.given and self.given.casefold() not in _POOL[self.script, self.gender] else [])]


def _long_names(text: str, listed: NameLists) -> Iterator[Name]:
    """The words of names of more than two: further given names, initials, particles; wide spaces; the family name first.

    Each word is a span of its own, so that what stands between stays.
    """
    for m in _CAPITAL.finditer(text):
        known = listed.get(m.group())
        if known is None:
            continue
        script, gender = known
        more, at, plain = [], m.end(), True
        while (n := _NEXT.match(text, at)) and (n.group(1).endswith(".") or listed.get(n.group(1)) is not None):
            more.append(n)
            at = n.end()
        while p := _PARTICLE.match(text, at):
            at, plain = p.end(), False
        n = _NEXT.match(text, at)
        if n is None or n.group(1).endswith("."):
            if not plain or len(more) < 2 or more[-1].group(1).endswith("."):
                continue
            n = more.pop()  # the last of several given names stands for the family's
        family = n.group(1)
        if scripts_of(family) != script or (plain and not more and n.start(1) == m.end() + 1):
            continue  # no long name, or one of two words
        for g in (m, *more):
            a, b = g.span() if g is m else g.span(1)
            if not text[a:b].endswith("."):
                yield Name(a, b, text[a:b], family, (listed.get(text[a:b]) or known)[1], script, True)
        yield Name(*n.span(1), None, family, gender, script)
    for m in _TURNED.finditer(text):
        known = listed.get(m.group(2))
        if known is not None and listed.get(m.group(1)) is None and scripts_of(m.group(1)) == known[0] and m.group(1).isupper():
            yield Name(*m.span(2), m.group(2), m.group(1), known[1], known[0], True)
            yield Name(*m.span(1), None, m.group(1), known[1], known[0])


def names_in(text: str, listed: NameLists = LISTED) -> Iterator[Name]:
    """Names in full, then the words of these names where they stand alone elsewhere in the text.

    Later ones may overlap earlier ones; the first of them counts.
    """
    families: dict[str, Name] = {}
    givens: dict[str, Name] = {}
    for n in _full_names(text, listed):
        yield n
        if len(n.family) > 2:
            families.setdefault(n.family.casefold(), n)
        if n.given and len(n.given) > 2:
            givens.setdefault(n.given.casefold(), n)
    # A word that the text has in lower case too is an ordinary one.
    for known in (families, givens):
        for word in [w for w in known if regex.search(rf"\b{regex.escape(w)}\b", text)]:
            del known[word]
    for m in _CAPITAL.finditer(text) if families or givens else ():
        word = regex.split("['’]", m.group())[0] if m.group().casefold() not in families else m.group()
        end = m.start() + len(word)
        if (n := families.get(word.casefold())) is not None:
            yield Name(m.start(), end, None, word, n.gender, n.script)
        elif (n := givens.get(word.casefold())) is not None:
            yield Name(m.start(), end, word, n.family, n.gender, n.script, True)


def _full_names(text: str, listed: NameLists) -> Iterator[Name]:
    """Listed given names with a family name, titles with one or both, and pairs of words that a cue tells."""
    seen = listed.seen(text)
    if "name" in seen:
        yield from _long_names(text, listed)
    at = 0
    while "name" in seen and (m := _NAME.search(text, at)):
        first, second, third = m.group(1), m.group(2), m.group(3)
        at = m.end(1)  # the second word may begin a name itself
        if (gender := _TITLE.get(first.casefold())) is not None:
            if third is not None and scripts_of(second) == scripts_of(third):
                known = listed.get(second)
                gender = known[1] if known and gender == "u" else gender
                yield Name(m.start(2), m.end(3), second, third, gender, scripts_of(third))
                at = m.end()
            else:
                yield Name(m.start(2), m.end(2), None, second, gender, scripts_of(second))
                at = m.end(2)
        elif (known := listed.get(first)) is not None and scripts_of(first) == scripts_of(second):
            script, gender = known
            yield Name(m.start(1), m.end(2), first, second, gender, script)
            at = m.end(2)
    for pattern, kind in ((_AFTER_CUE, "after"), (_BEFORE_CUE, "before")):
        for m in pattern.finditer(text) if kind in seen else ():
            first, second = m.group(1), m.group(2)
            if first.casefold() in _TITLE or scripts_of(first) != scripts_of(second):
                continue
            script, gender = listed.get(first, (scripts_of(first), "u"))
            yield Name(m.start(1), m.end(2), first, second, gender, script)


def streets_in(text: str, listed: NameLists = LISTED) -> Iterator[tuple[tuple[int, int], tuple[int, int], str]]:
    """(span of the house number, span of the street's name, its token)."""
    for pattern in _STREETS if _DIGIT.search(text) and "street" in listed.seen(text) else ():
        for m in pattern.finditer(text):
            yield m.span("n"), m.span("v"), f"street|{scripts_of(m.group('v'))}||{m.group('v').casefold()}"


class Spans:
    """Spans of a text that do not overlap, in order."""

    def __init__(self):
        self.starts: list[int] = []
        self.rows: list[tuple] = []

    def add(self, start: int, end: int, *row) -> bool:
        """False, and nothing added, if what is there reaches into it."""
        at = bisect.bisect_left(self.starts, start)
        if (at and self.rows[at - 1][1] > start) or (at < len(self.rows) and self.starts[at] < end):
            return False
        self.starts.insert(at, start)
        self.rows.insert(at, (start, end, *row))
        return True


def _plain(text: str) -> str:
    return "".join(c for c in text if c.isalnum())


def _is_card(text: str) -> bool:
    digits = [int(c) for c in text if c.isdigit()]
    return luhn(digits[:-1]) == digits[-1]


def _is_iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _is_ipv6(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return text.count(":") > 2


def _is_phone(text: str) -> bool:
    return 7 <= sum(c.isdigit() for c in text) <= 17


_VALID = {"card": _is_card, "iban": _is_iban, "ipv6": _is_ipv6, "phone": _is_phone, "birth": lambda t: parsed_date(t) is not None}


def parsed_date(text: str) -> tuple[datetime.date, list[str], str] | None:
    """A date, the order of its parts and the sign between them; None if there is no such day.

    The year stands where it has four digits.  Of day and month the first is the
    day unless that cannot be, or the sign is a slash and both can.
    """
    sign = next(c for c in text if not c.isdigit())
    if text.count(sign) != 2:
        return None
    a, b, c = map(int, text.split(sign))
    if a > 31:
        order = ["y", "m", "d"]
    elif b > 12 or (sign == "/" and a <= 12):
        order = ["m", "d", "y"]
    else:
        order = ["d", "m", "y"]
    parts = dict(zip(order, (a, b, c)))
    try:
        day = datetime.date(parts["y"], parts["m"], parts["d"])
    except ValueError:
        return None
    return (day, order, sign) if FIRST_DAY <= day.toordinal() < FIRST_DAY + DAYS else None


#: Dates of birth are permuted among these days: from 1900 on, two centuries.
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY


def mentions(text: str, listed: NameLists = LISTED) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, text) of what the patterns find, in order, none over another.

    Patterns whose signs or words the text does not hold are not tried.
    """
    found = Spans()
    digits, signs = _DIGIT.search(text), ":" in text or "-" in text
    may = {k: digits for k in _FOUND} | {"email": "@" in text, "ipv6": ":" in text, "mac": signs, "secret": digits or "secret" in listed.seen(text)}
    for kind, pattern in _FOUND.items():
        if not may[kind]:
            continue
        for m in pattern.finditer(text):
            a, b = m.span("v") if "v" in pattern.groupindex else m.span()
            if _VALID.get(kind, len)(text[a:b]):
                found.add(a, b, kind, text[a:b])
    return found.rows


def cased_like(word: str, model: str) -> str:
    return word.upper() if len(model) > 1 and model.isupper() else word


#: Symbols that one permutation takes.
BLOCK = 64


class Surrogates:
    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def number(self, *parts: object) -> int:
        return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "replace"), key=self.key).digest(), "big")

    def permuted(self, symbols: list[int], radices: list[int], tweak: str) -> list[int]:
        """Ten Feistel rounds over two halves of the mixed-radix number: a bijection of its domain.

        A long sequence goes block by block, each block keyed by what stands before it.
        """
        if len(symbols) > BLOCK:
            out, before = [], hashlib.blake2b()
            for at in range(0, len(symbols), BLOCK):
                block = symbols[at : at + BLOCK]
                out += self.permuted(block, radices[at : at + BLOCK], f"{tweak}|{at}|{before.hexdigest()}")
                before.update(bytes(block))
            return out
        half = len(symbols) // 2
        sides, sizes = [0, 0], [1, 1]
        for i, (s, r) in enumerate(zip(symbols, radices)):
            side = int(i >= half)
            sides[side], sizes[side] = sides[side] * r + s, sizes[side] * r
        for step in range(10):
            a = step % 2
            sides[a] = (sides[a] + self.number("round", tweak, step, sides[1 - a])) % sizes[a]
        out: list[int] = []
        for side, rs in ((1, radices[half:]), (0, radices[:half])):
            n, part = sides[side], []
            for r in reversed(rs):
                n, s = divmod(n, r)
                part.append(s)
            out = part[::-1] + out
        return out

    def same_format(self, text: str, kind: str, fixed: int = 0, hexadecimal: bool = False) -> str:
        """Digits for digits and letters for letters of the same case; the rest, and `fixed` symbols, stay.

        The permutation sees the symbols without case and signs, so that one
        entity in two formats has one surrogate in both.
        """
        alphabet = "0123456789abcdef" if hexadecimal else None
        at = [i for i, c in enumerate(text) if c.isascii() and c.isalnum()][fixed:]
        if not at:
            return text
        low = [text[i].lower() for i in at]
        sets = [alphabet or ("0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz") for c in low]
        shape = "".join("9" if len(s) == 10 else "h" if len(s) == 16 else "a" for s in sets) if len(sets) <= BLOCK else len(sets)
        new = self.permuted([s.index(c) for s, c in zip(sets, low)], [len(s) for s in sets], f"{kind}|{shape}")
        upper = any(text[i].isupper() for i in at) if hexadecimal else None
        out = list(text)
        for i, s, n in zip(at, sets, new):
            c = s[n]
            out[i] = c.upper() if (upper if hexadecimal else text[i].isupper()) else c
        return "".join(out)

    def of(self, kind: str, text: str) -> str:
        if kind == "email":
            body, _, top = text.rpartition(".")
            return f"{self.same_format(body, f'email.{top.lower()}')}.{top}"
        if kind == "ip":
            n = int(ipaddress.IPv4Address(".".join(str(int(x)) for x in text.split("."))))
            halves = self.permuted([n >> 16, n & 0xFFFF], [1 << 16, 1 << 16], "ip")
            return str(ipaddress.IPv4Address(halves[0] << 16 | halves[1]))
        if kind == "ipv6":
            n = int(ipaddress.IPv6Address(text))
            halves = self.permuted([n >> 64, n & (1 << 64) - 1], [1 << 64, 1 << 64], "ipv6")
            new = ipaddress.IPv6Address(halves[0] << 64 | halves[1])
            new = str(new) if "::" in text else new.exploded
            return new.upper() if text.isupper() else new
        if kind == "birth":
            day, order, sign = parsed_date(text)
            n = self.walked(day.toordinal() - FIRST_DAY, DAYS, "birth")
            new = datetime.date.fromordinal(FIRST_DAY + n)
            widths = [len(x) for x in text.split(sign)]
            return sign.join(str({"y": new.year, "m": new.month, "d": new.day}[k]).zfill(w) for k, w in zip(order, widths))
        if kind == "house":
            return str(10 ** (len(text) - 1) + self.walked(int(text) - 10 ** (len(text) - 1), 9 * 10 ** (len(text) - 1), f"house|{len(text)}")) if text[0] != "0" else self.same_format(text, kind)
        if kind == "card":
            at = [i for i, c in enumerate(text) if c.isdigit()]
            digits = [int(text[i]) for i in at]
            off = (digits[-1] - luhn(digits[:-1])) % 10  # valid stays valid
            new = digits[:1] + self.permuted(digits[1:-1], [10] * (len(digits) - 2), f"card|{digits[0]}|{len(digits)}|{off}")
            new.append((luhn(new) + off) % 10)
            out = list(text)
            for i, d in zip(at, new):
                out[i] = str(d)
            return "".join(out)
        if kind == "iban":
            plain = text.replace(" ", "")
            body = self.same_format(plain[4:], f"iban|{plain[:2]}|{self._iban_off(plain)}")
            want = (98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97 + self._iban_off(plain)) % 97
            new = iter(f"{plain[:2]}{want:02d}{body}")
            return "".join(c if c == " " else next(new) for c in text)
        if kind == "phone":
            return self.phone(text)
        if kind == "secret":
            prefix = next((p for p in KEY_PREFIXES if text.startswith(p)), "")
            return prefix + self.symbols(text[len(prefix) :], f"secret|{prefix}")
        if kind == "mac":
            return self.symbols(text, kind)
        return self.same_format(text, kind)

    def symbols(self, text: str, kind: str) -> str:
        """Hexadecimal digits for hexadecimal ones where the text has no others, in one case; else as same_format()."""
        plain = _plain(text)
        one_case = plain.islower() or plain.isupper()
        return self.same_format(text, kind, hexadecimal=one_case and all(c in "0123456789abcdefABCDEF" for c in plain))

    def phone(self, text: str) -> str:
        """The digits after the calling code permuted; code, signs and a trunk zero in parentheses stay.

        With + or 00 before it a number is international and its surrogate depends
        on the digits alone; a national one is a number of its own.
        """
        trunk = text.find("(0)")
        at = [i for i, c in enumerate(text) if c.isdigit() and not (0 <= trunk <= i <= trunk + 2)]
        if text.startswith("00"):
            at = at[2:]
        digits = "".join(text[i] for i in at)
        code = 0
        if text.startswith(("+", "00")):
            code = 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGIT_CODES else 3
        rest = [int(c) for c in digits[code:]]
        new = self.permuted(rest, [10] * len(rest), f"phone|{digits[:code]}|{len(rest)}")
        out = list(text)
        for i, d in zip(at[code:], new):
            out[i] = str(d)
        return "".join(out)

    def walked(self, n: int, size: int, tweak: str) -> int:
        """A permutation of the numbers below `size`: the permuted number again until it is one of them."""
        side = math.isqrt(size - 1) + 1
        while True:
            a, b = self.permuted(list(divmod(n, side)), [side, side], f"{tweak}|{size}")
            n = a * side + b
            if n < size:
                return n

    @staticmethod
    def _iban_off(plain: str) -> int:
        """How far the check digits are from valid ones: 0 stays 0."""
        valid = 98 - int("".join(str(int(c, 36)) for c in plain[4:] + plain[:2] + "00")) % 97
        return (int(plain[2:4]) - valid) % 97

    def invented(self, token: str, attempt: int = 0) -> str:
        """A new word for a token (what, script, gender, word); each attempt gives another, longer one."""
        what, script, gender, _ = token.split("|", 3)
        n = self.number("word", token, attempt)
        word = "".join(SYLLABLES[script][n >> 5 * i & 31] for i in range(4 + n % 2 + attempt)).capitalize()
        return word + (ENDINGS.get((script, gender), "") if what == "family" else "")

    def given(self, name: Name, attempts: dict[str, int]) -> str:
        """A listed name's place in its list permuted for each family; another name by an invented word."""
        pool = GIVEN[name.script, name.gender]
        at = _POOL[name.script, name.gender].get(name.given.casefold())
        if at is None:
            return self.invented(name.given_token, attempts.get(name.given_token, 0))
        return pool[self.walked(at, len(pool), f"given|{name.script}|{name.gender}|{name.family.casefold()}")]

    def renamed(self, name: Name, attempts: dict[str, int]) -> str:
        if name.given_only:
            return cased_like(self.given(name, attempts), name.given)
        family = cased_like(self.invented(name.family_token, attempts.get(name.family_token, 0)), name.family)
        return f"{cased_like(self.given(name, attempts), name.given)} {family}" if name.given else family

    def replaced(self, text: str, attempts: dict[str, int], listed: NameLists = LISTED) -> tuple[str, int]:
        """The text with surrogates, and how many."""
        spans = Spans()
        for a, b, kind, value in mentions(text, listed):
            spans.add(a, b, self.of(kind, value))
        for n in names_in(text, listed):
            spans.add(n.start, n.end, self.renamed(n, attempts))
        for (a, b), (c, d), token in streets_in(text, listed):
            spans.add(a, b, self.of("house", text[a:b]))
            spans.add(c, d, cased_like(self.invented(token, attempts.get(token, 0)), text[c:d]))
        out, at = [], 0
        for a, b, new in spans.rows:
            out += [text[at:a], new]
            at = b
        return "".join(out) + text[at:], len(spans.rows)


#: Words drawn again go to the tasks as a table up to so many rows; beyond, by a join with the documents that hold them.
MAX_BROADCAST_NAMES = 100_000


def token_mentions(docs: DataFrame, text_col: str, listed: NameLists = LISTED) -> DataFrame:
    """(of, token) for each distinct word to invent of each text, `of` being the text's 64-bit hash."""

    def tokens(text: str) -> list[str]:
        return sorted({x for n in names_in(text, listed) for x in n.tokens} | {x for _, _, x in streets_in(text, listed)})

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(i, x) for i, t in zip(b["of"], b["text"]) for x in tokens(t)], columns=["of", "token"])

    texts = docs.select(F.xxhash64(text_col).alias("of"), F.col(text_col).alias("text")).filter("text is not null")
    return texts.mapInPandas(find, "of long, token string")


def drawn_again(tokens: DataFrame, key: bytes) -> DataFrame:
    """(token, attempt) of the distinct tokens whose first word met another's, or is one that the corpus has.

    Of tokens with one word the smallest keeps it; the others draw again, and so
    does each whose word is itself the word of a token.  Rounds end when all
    words differ; each has more words to choose from than the one before.
    """
    maker = Surrogates(key)

    @F.pandas_udf("string")
    def word(token: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([maker.invented(t, int(a)).casefold() for t, a in zip(token, attempt)], dtype=object)

    rows = tokens.select("token").distinct().withColumn("attempt", F.lit(0))
    while True:
        rows = staged(rows.withColumn("new", word("token", "attempt")).select("token", "attempt", "new"), "surrogate-words")
        had = rows.select(F.element_at(F.split("token", r"\|", 4), -1).alias("new")).distinct().withColumn("keeper", F.lit(""))
        met = rows.groupBy("new").agg(F.count("*").alias("n"), F.min("token").alias("keeper")).filter("n > 1").select("new", "keeper")
        bad = met.unionByName(had.join(rows.select("new"), "new", "left_semi")).groupBy("new").agg(F.min("keeper").alias("keeper"))
        moved = staged(rows.join(bad, "new").filter("token <> keeper").select("token", (F.col("attempt") + 1).alias("to")), "surrogate-moves")
        if moved.isEmpty():
            return rows.filter("attempt > 0").select("token", "attempt")
        rows = rows.join(moved, "token", "left").select("token", F.coalesce("to", "attempt").alias("attempt"))


def with_surrogates(
    docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", max_broadcast: int = MAX_BROADCAST_NAMES, more_names: dict[tuple[str, str], list[str]] | None = None
) -> DataFrame:
    """doc_id, text with surrogates, entities (how many mentions were replaced).

    Every row gives one row, the whole text is searched.  A null text stays null
    and an empty one empty, with 0 entities; repeated rows give repeated rows;
    the same entity has the same surrogate in every row and in every run with
    the same key; an empty table gives none.  Other columns are not looked at.
    `more_names` adds given names by script and gender to those of the list.
    """
    spark = docs.sparkSession
    small_batches(spark)
    listed = NameLists(more_names)
    found = staged(token_mentions(docs, text_col, listed), "name-mentions")
    again = staged(drawn_again(found, key), "names-again")
    maker = Surrogates(key)
    table: dict[str, int] = {}
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if again.count() <= max_broadcast:
        table = {r["token"]: r["attempt"] for r in again.collect()}  # checked above
        rows = rows.withColumn("again", F.lit(None).cast("array<struct<token:string,attempt:int>>"))
    else:
        word = F.struct("token", F.col("attempt").cast("int").alias("attempt"))
        again = found.join(again, "token").groupBy("of").agg(F.collect_set(word).alias("again"))  # distinct words of one text
        rows = rows.withColumn("of", F.xxhash64("text"))
        again = staged(rows.join(again, "of").groupBy("of").agg(F.count("*").alias("n"), F.any_value("again").alias("again")), "text-words")
        rows = with_group(rows, again, "of", "n", how="left").select("doc_id", "text", "again")
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("text string, entities long")
    def replace(texts: pd.Series, again: pd.Series) -> pd.DataFrame:
        out = []
        for t, more in zip(texts, again):
            own = shared.value if more is None else {x["token"]: x["attempt"] for x in more}
            out.append((None, 0) if t is None else maker.replaced(t, own, listed))
        return pd.DataFrame(out, columns=["text", "entities"])

    rows = rows.select("doc_id", replace("text", "again").alias("r"))
    return rows.select("doc_id", "r.text", "r.entities")
