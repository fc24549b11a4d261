"""Personal data replaced by keyed surrogates that keep type, gender, script and format.

Entities found in a text are split into a kind and a canonical value: two ways to write a
phone number, or a name in full and the surname alone, share canonical values. A surrogate
is drawn from a keyed hash (HMAC) of kind, canonical value and attempt, and written in the
form of the occurrence: punctuation, case, digit groups, checksums, the gender of a first name and the
script of every letter stay. So equal entities get equal surrogates in the whole corpus.

Names are found after a title (Mr, Frau, Dr, ...), and so is every other capitalised mention of
a found given or family name in the same document, before or after it. What stays: names of a document that
no title stands before there, words behind the second one after a title, names that begin with
a small particle (von, de), inflected forms, and common first words of sentences (NO_NAMES). A given name behind a
neutral title has the gender of a gendered mention in the document or of the lists below, or none.

Phone numbers are digit groups of 8 to 15 digits in all, with or without a country code, that are no
date, year, amount, ISBN or other kind of entity; unbroken ones need a country code, a leading 0,
or the form of a North American or Spanish number. Country code and leading zeros stay, so national and
international forms share a canonical value. Without a code, lists of numbers of one or two digits
(10 20 30 40) and pairs of groups without a leading 0 (1234 5678) stay, as they are rarely phones.

Collision checks keep different entities apart: over the distinct entities of the corpus, a
surrogate that two entities of a kind draw, or that some document really contains as an
entity, sends all but the first of them to the next attempt, until none is left. Later
attempts may lengthen a value, so short formats do not run out.

Scale: first attempts are computed where the text is. Only entities on later attempts are
looked up: as a table within the function while there are at most TOLD of them (a measured
bound), by a join on the document beyond that. The text is read twice and, without
that join, not shuffled. Equal entities are reduced per task before the shuffle.

Defined results: a null text stays null, an empty one empty; both have no entities; repeated
rows get the same surrogates; an empty table gives no rows; all other columns are kept.
"""

from __future__ import annotations

import hmac
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packedts.llm.batches import small_batches
from packedts.llm.components import stored

TOLD = 10_000
ATTEMPTS = 60
LENGTHEN = 6
SLICE = 500

# Cues of names and the names that stand in, by gender and script.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sir", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "госпожа"),
    "n": ("Dr", "Prof", "Doctor", "Professor", "Doktor", "Docteur", "Professeur", "Doctora", "Profesor", "Profesora", "доктор", "профессор"),
}
# as written here, in capitals, and small as some languages have them ("miss" is a verb)
GENDER_OF = {form: g for g, titles in TITLES.items() for t in titles for form in {t, t.upper(), t if t == "Miss" else t.lower()}}
NO_NAMES = set(
    "the a an this that these those there then he she it i we you they his her its my our your their who what when where why how and but or if in on at for as so no not yes "
    "der die das ein eine er sie es ich wir ihr und aber oder wenn im am auf für so nicht ja nein wer was wann wo warum wie dies diese dieser "
    "le la les un une il elle ils elles on je tu nous vous et mais ou si dans pour que qui ce cette ces oui non "
    "el los las una unos ella ellos yo nosotros y pero o en por para qué quién este esta sí "
    "он она оно они я мы вы и но а в на это как что кто где когда".split()
)
GIVEN = {
    ("m", "latin"): "Adam Boris Carl Daniel Emil Felix Georg Hugo Ivan Jonas Karim Leon Marco Nils Oscar Paul Quentin Rafael Simon Tomas Ulrich Victor Walter Xavier".split(),
    ("f", "latin"): "Anna Bella Clara Diana Elena Fiona Greta Helen Irene Julia Karla Laura Maria Nina Olga Paula Rosa Sara Tina Ursula Vera Wanda Yvonne Zoe".split(),
    ("n", "latin"): "Alexis Andy Camille Chris Dana Dominique Francis Jo Kim Lou Maxime Noa Pat Robin Sasha Toni".split(),
    ("n", "cyrillic"): "Валя Женя Саша Слава Шура".split(),
    ("m", "cyrillic"): "Андрей Борис Виктор Григорий Дмитрий Иван Лев Максим Олег Павел".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Ирина Лариса Мария Ольга Полина".split(),
}
FAMILY = {
    "latin": "Abel Brandt Carver Dorn Ekman Fischer Garner Holm Ibsen Jansen Keller Lang Moreau Novak Olsen Parker Quist Renard Sander Torres Urban Vogel Weiss Young Ziegler".split(),
    "cyrillic": "Белов Волков Громов Егоров Жуков Козлов Лебедев Морозов Орлов Соколов".split(),
}
ALPHABETS = (
    "abcdefghijklmnopqrstuvwxyz",
    "àáâãäåæçèéêëìíîïñòóôõöøùúûüý",
    "абвгдежзийклмнопрстуфхцчшщыэюя",
    "αβγδεζηθικλμνξοπρστυφχψω",
)

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = "|".join(GENDER_OF)
_NAME = r"[^\W\d_]+(?:-[^\W\d_]+)*"
PATTERNS = {
    "email": re.compile(r"(?<![\w.%+@-])[\w%+-]+(?:\.[\w%+-]+)*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w@-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "card": re.compile(r"(?<![\w.+-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|3[47]\d\d([ -])\d{6}\2\d{5})(?!\w)"),
    "ip": re.compile(rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "ipv6": re.compile(rf"(?<![\w:.])(?:[0-9A-Fa-f]{{0,4}}:){{2,7}}(?:(?:{_OCTET}\.){{3}}{_OCTET}|[0-9A-Fa-f]{{1,4}})?(?![\w:]|\.\d)"),
    "name": re.compile(rf"\b((?:(?:{_TITLE})\b\.?[ \u00a0])+)({_NAME})(?:[ \u00a0]({_NAME}))?"),
}
MENTION = re.compile(_NAME)
_SEP = "[ \u00a0\u202f.-]"
#: So many groups hold more than the 15 digits of the longest number.
GROUPS = 18
#: A long row of numbers with one separator.
ROW = re.compile(rf"(?<![\w+.])\d{{1,8}}({_SEP})\d{{1,8}}(?:\1\d{{1,8}}){{{3 * GROUPS},}}(?!\w)")
#: An optional country code, area codes in brackets, and groups with one separator from the second on.
PHONE = re.compile(
    rf"(?<![\w+])(?<!\d\.)(?:\+\d{{8,15}}|0\d{{8,14}}|[2-9]\d{{8,9}}|1[2-9]\d{{9}}"
    rf"|(?P<code>(?:\+|00)\d{{1,3}}{_SEP}?)?(?P<area>(?:\(\d{{1,5}}\)[ \u00a0\u202f./-]?){{1,2}})\d{{1,8}}(?:({_SEP})\d{{1,8}}(?:\3\d{{1,8}}){{0,{GROUPS - 2}}})?"
    rf"|(?:(?:\+|00)\d{{1,3}}{_SEP})?\d{{1,8}}[ \u00a0\u202f./-]\d{{1,8}}(?:({_SEP})\d{{1,8}}(?:\4\d{{1,8}}){{0,{GROUPS - 2}}})?)(?!\w)"
)
#: Usual forms, by which a row of several numbers is parted.
FORMS = [re.compile(rf"(?:{f})(?!\w)") for f in (r"(?:(?:\+|00)?\d{1,3}[ .-])?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}", rf"0\d(?:{_SEP}\d\d){{4}}", rf"\d{{3}}(?:{_SEP}\d\d){{3}}")]
_DAY, _MONTH, _YEAR = r"(?:0?[1-9]|[12]\d|3[01])", r"(?:0?[1-9]|1[0-2])", r"(?:19|20)\d\d"
DATE = re.compile(rf"(?:{_YEAR}([ ./-]){_MONTH}\1{_DAY}|(?:{_DAY}([ ./-]){_MONTH}|{_MONTH}([ ./-]){_DAY})[ ./-]{_YEAR}|{_YEAR}([ -]){_YEAR}(?:\4{_YEAR})*)(?!\d)")
HIDDEN = "\0"
CURRENCIES = set("$€£¥₽")
TITLED = re.compile(rf"\b(?:{_TITLE})\b")
GIVEN_GENDER = {name.lower(): g for (g, _), names in GIVEN.items() if g != "n" for name in names}


def _is_name(word: str | None) -> bool:
    return bool(word) and word[0].isupper() and word.lower() not in NO_NAMES


def _luhn(digits: str) -> int:
    """The Luhn sum of all digits; 0 if the last one is right."""
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10


def _iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """start, end, kind and canonical value of every entity; they do not overlap.

    Where patterns overlap, the one that starts first wins, then the earlier kind.
    """
    kinds = []
    if "@" in text:
        kinds.append("email")
    if re.search(r"\d\D{0,3}\d", text):
        kinds += ["iban", "card", "ip", "ssn"]
    numbers = "iban" in kinds
    if text.count(":") > 1:
        kinds.append("ipv6")
    found = []
    if TITLED.search(text):
        found += [(s, len(kinds), e, k, v) for s, e, k, v in _names(text)]
    for place, kind in enumerate(kinds):
        for m in PATTERNS[kind].finditer(text):
            start, value = m.start(), m.group()
            if kind == "email":
                value = value.lower()
            elif kind == "ipv6":
                if not (value := _ipv6(value)):
                    continue
            elif kind != "ip":
                value = re.sub(r"[ -]", "", value)
            if kind == "iban" and _iban_check(value[:2], value[4:]) != value[2:4]:
                continue
            found.append((start, place, m.end(), kind, value))
    out = _apart(found)
    if numbers:
        # phones are what the digits outside of all other kinds may be
        left, at = [], 0
        for start, end, _, _ in out:
            left += [text[at:start], HIDDEN * (end - start)]
            at = end
        phones = [(s, 0, e, "phone", v) for s, e, v in _phones("".join([*left, text[at:]]))]
        out = _apart([*((s, 0, e, k, v) for s, e, k, v in out), *phones]) if phones else out
    return out


def _apart(found: list[tuple[int, int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    out: list[tuple[int, int, str, str]] = []
    for start, _, end, kind, value in sorted(found):
        if not out or start >= out[-1][1]:
            out.append((start, end, kind, value))
    return out


def _ipv6(value: str) -> str | None:
    """All 32 digits of an address; none for what is no address of a machine, or a::b in program text."""
    try:
        address = ipaddress.IPv6Address(value)
    except ValueError:
        return None
    if address.is_loopback or address.is_unspecified or not re.search(r"\d", value):
        return None
    return f"{int(address):032x}"


def _phones(text: str) -> Iterator[tuple[int, int, str]]:
    """Where a phone number begins after its country code and leading zeros, its end, and its digits from there on."""
    at = 0
    rows = _rows(text)
    row = next(rows, None)
    while m := PHONE.search(text, at):
        start, end = m.span()
        while row and row[0][-1] <= start:
            row = next(rows, None)
        if row and row[0][0] <= start:
            begins, onward = row
            place = bisect_left(begins, start)
            if begins[place] == start < onward[place]:
                at = onward[place]
                continue
        at = start + re.match(r"\D*\d+", m.group()).end()
        if date := DATE.match(text, start):
            at = max(at, date.end())
            continue
        if sum(map(str.isdigit, m.group())) > 15:
            # several numbers in a row
            ends = [f.end() for form in FORMS if (f := form.match(text, start)) and f.end() <= end]
            ends += [start + g.end() for g in reversed(list(re.finditer(r"\d+", m.group())))]
            end = next((e for e in ends if 8 <= sum(map(str.isdigit, text[start:e])) <= 15 and _is_phone(text, start, e)), 0)
        elif not _is_phone(text, start, end):
            end = 0
        if end:
            at = end
            code = re.match(rf"(?:\+[17](?=\d{{10}}$)|(?:\+|00)(?:\d{{1,3}}(?=[ \u00a0\u202f.(-])|\d\d)|1(?={_SEP}?\(?[2-9]\d\d\)?{_SEP}?\d{{3}}{_SEP}?\d{{4}}$))", text[start:end])
            start += code.end() if code else 0
            start += re.match(r"[^1-9]*", text[start:end]).end()
            if value := re.sub(r"\D", "", text[start:end]):
                yield start, end, value


def _rows(text: str) -> Iterator[tuple[list[int], list[int]]]:
    """Where the numbers of each long row begin, but for the last GROUPS, and the next one from each on where a phone number or a date may begin.

    A phone number of the row is 2 to 15 of its numbers, and their sizes rule most out at once.
    """
    for m in ROW.finditer(text):
        data = np.frombuffer(m.group().encode("utf-32-le"), "<u4")
        digit = (data >= ord("0")) & (data <= ord("9"))
        edge = np.diff(np.concatenate([[0], digit.view(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        size, n = last - first, len(first) - GROUPS
        total = np.append(0, np.cumsum(size))
        zero = data[first[:n]] == ord("0")
        s0, s1, s2 = size[:n], size[1 : n + 1], size[2 : n + 2]
        may = (s0 == 4) | ((s0 <= 2) & (s1 <= 2) & (s2 == 4))  # a date
        most, threes = np.maximum(s0, s1), s1 == 3
        for count in range(2, 16):
            if count > 2:
                most = np.maximum(most, size[count - 1 : n + count - 1])
                threes = threes & (size[count - 1 : n + count - 1] == 3)
            digits = total[count : n + count] - total[:n]
            form = (s0 == 3) & (s1 >= 6) if count == 2 else (most > 2) & (count < 7)
            if m.group(1) != "-":  # an amount in thousands
                form = form & ~(threes & (s0 < 4) & ((count != 3) | (s0 < 3) | (data[first[:n]] < ord("6"))))
            may |= (digits >= 8) & (digits <= 15) & (zero | form & (size[count - 1 : n + count - 1] > 1))
        may[-1] = True
        begins = m.start() + first[:n]
        yield begins.tolist(), begins[may][np.cumsum(may) - may].tolist()


def _is_phone(text: str, start: int, end: int) -> bool:
    value = text[start:end]
    groups = re.findall(r"\d+", value)
    sizes, digits = [len(g) for g in groups], "".join(groups)
    if not 8 <= len(digits) <= 15 or not digits.strip("0"):
        return False
    if value[0] == "+" or "(" in value or value.startswith("00") and len(digits) > 9:
        return True
    if len(groups) == 1:
        # by plan: leading 0; North American with and without its code; Spanish
        return bool(re.fullmatch(r"0[1-9]\d{7,10}|1?[2-9]\d\d[2-9]\d{6}|[6-9]\d{8}", value))
    spanish = sizes == [3, 3, 3] and value[0] in "6789" and "." not in value
    if text[max(0, start - 2) : start].strip()[-1:] in CURRENCIES or text[end : end + 2].strip()[:1] in CURRENCIES:
        return False
    if sizes[0] <= 3 and value[0] != "0" and set(sizes[1:]) == {3} and not (spanish and not re.match(r",\d\d?(?!\d)", text[end : end + 4])) and "-" not in value:
        return False  # an amount in thousands
    if len(digits) == 13 and len(groups) > 3 and digits.startswith(("978", "979")):
        return False  # an ISBN
    if sizes[-1] == 1 or "." in value and min(sizes) == 1:
        return False
    if digits[0] == "0" and sizes[0] > 1:
        return len(groups) > 2 or "." not in value
    if len(groups) == 2:
        return sizes in ([3, 7], [3, 6]) and "." not in value
    return len(groups) < 7 and max(sizes) > 2


def _names(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Names behind titles, and all other capitalised mentions of them."""
    titled: dict[tuple[int, int], tuple[str, str]] = {}
    for m in PATTERNS["name"].finditer(text):
        gender = next((g for t in MENTION.findall(m.group(1)) if (g := GENDER_OF[t]) != "n"), "n")
        if _is_name(m.group(2)) and _is_name(m.group(3)):
            titled[m.span(2)] = (f"given_{gender}", m.group(2).lower())
            titled[m.span(3)] = ("family", m.group(3).lower())
        elif _is_name(m.group(2)):
            titled[m.span(2)] = ("family", m.group(2).lower())
    gendered = {value: kind for kind, value in titled.values() if kind in ("given_m", "given_f")}
    for span, (kind, value) in titled.items():
        if kind == "given_n":
            titled[span] = gendered.get(value) or f"given_{GIVEN_GENDER.get(value, 'n')}", value
    # a name that is both is what it is first
    kind_of = {value: kind for kind, value in reversed(titled.values())}
    yield from ((*span, *entity) for span, entity in titled.items())
    if not titled:
        return
    for m in MENTION.finditer(text):
        whole = m.group().lower() in kind_of
        for part in [m] if whole else re.finditer(r"[^-]+", m.group()):
            start = m.start() if whole else m.start() + part.start()
            value, end = part.group().lower(), start + len(part.group())
            if value in kind_of and part.group()[0].isupper() and (start, end) not in titled:
                yield start, end, kind_of[value], value


class Draw:
    """A stream of numbers from the key, a kind, a canonical value and an attempt."""

    def __init__(self, key: bytes, *parts: object) -> None:
        self.seed, self.count, self.pool = "\x1f".join(map(str, parts)).encode(), 0, 0
        self.key, self.left = key, 0

    def below(self, n: int) -> int:
        if self.left < 2:
            self.pool = int.from_bytes(hmac.digest(self.key, self.seed + self.count.to_bytes(4, "big"), "sha256"))
            self.count, self.left = self.count + 1, 16
        self.pool, at = divmod(self.pool, 1 << 16)
        self.left -= 1
        return at * n >> 16

    def letter(self, old: str) -> str:
        """A letter of the same alphabet and case, or a digit for a digit; other characters stay."""
        if old.isdigit():
            return str(self.below(10))
        for alphabet in ALPHABETS:
            if old.lower() in alphabet:
                new = alphabet[self.below(len(alphabet))]
                return new.upper() if old.isupper() else new
        if old.isalpha() and ord(old) >= 0x500:  # any other script: a letter close by
            near = [chr(c) for c in range(ord(old) - 8, ord(old) + 9) if chr(c).isalpha()]
            return near[self.below(len(near))]
        return old

    def hex(self, old: str, more: int) -> str:
        """As many hexadecimal digits, or all four with more; nothing for nothing."""
        size = 4 if more and old else len(old)
        return "".join("0123456789abcdef"[1 + self.below(15) if k == 0 else self.below(16)] for k in range(size))

    def spelled(self, old: str) -> str:
        return "".join(map(self.letter, old))


def _script(name: str) -> str | None:
    if all(c in ALPHABETS[2] or c == "ё" or not c.isalpha() for c in name):
        return "cyrillic"
    return "latin" if all(ord(c) < 0x250 for c in name) else None


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical value."""
    draw = Draw(key, kind, value, attempt)
    more = max(0, attempt - LENGTHEN + 1)
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        # the same for all addresses of a domain; its last label stays, and so do reserved names
        keep = 2 if labels[-2] == "example" else 1
        fixed = Draw(key, "domain", domain)
        labels[:-keep] = [fixed.spelled(label) for label in labels[:-keep]]
        return draw.spelled(local) + "".join(draw.letter("a") for _ in range(more)) + "@" + ".".join(labels)
    if kind == "card":
        body = value[0] + draw.spelled(value[1:-1])
        checks = [d for d in "0123456789" if (_luhn(body + d) == 0) == (_luhn(value) == 0)]
        return body + checks[draw.below(len(checks))]
    if kind == "ip":
        sizes = [len(o) for o in value.split(".")]
        ranges = ((0, 10), (10, 100), (100, 255)) if not more else ((1, 255),) * 3
        return ".".join(str(low + draw.below(high - low)) for low, high in (ranges[s - 1] for s in sizes))
    if kind == "ipv6":
        groups = [value[k : k + 4].lstrip("0") for k in range(0, 32, 4)]
        # the first group stays, and so do zeros, which may be left out, and the mark of a mapped IPv4 address
        first = next(k for k, g in enumerate(groups) if g)
        kept = first if any(groups[first + 1 :]) and (first == 0 or first == 5 and groups[5] == "ffff") else -1
        new = [g if k == kept else draw.hex(g, more) for k, g in enumerate(groups)]
        return "".join(g.zfill(4) for g in new)
    if kind == "ssn":
        return "9" + draw.spelled(value[1:])
    if kind == "phone":
        first = value[0] if value[0] == "1" else str(2 + draw.below(8))
        return first + draw.spelled(value[1:])
    if kind == "iban":
        rest = draw.spelled(value[4:])
        return value[:2] + _iban_check(value[:2], rest) + rest
    # names
    script = _script(value)
    names = FAMILY.get(script, ()) if kind == "family" else GIVEN.get((kind[-1], script), ())
    if not names:
        return draw.spelled(value) + "".join(draw.letter(value[0]) for _ in range(more))
    name = names[draw.below(len(names))].lower()
    if attempt:  # lists are short: further names are spelled on from a listed one
        name += "".join(draw.letter(name[-1]) for _ in range(1 + attempt // 2))
    return name


def written(kind: str, old: str, new: str) -> str:
    """The canonical surrogate in the form of an occurrence."""
    if kind in ("card", "ssn", "phone", "iban"):
        rest = iter(new)
        return "".join(next(rest) if c.isalnum() else c for c in old)
    if kind == "ip":
        return new
    if kind == "ipv6":
        groups = [new[k : k + 4] for k in range(0, 32, 4)]
        head, _, tail = old.rpartition(":")
        if "." in tail:
            old = f"{head}:0:0"
        parts = old.split(":")
        first, _, last = old.partition("::")
        count = len(first.split(":")) if first else 0
        for k, part in enumerate(parts):
            if part:
                at = k if k < count else k - len(parts) + 8
                parts[k] = (groups[at].lstrip("0") or "0").zfill(len(part))
                parts[k] = parts[k].upper() if part.isupper() else parts[k]
        if "." in tail:
            parts[-2:] = [".".join(str(b) for b in bytes.fromhex(new[24:]))]
        return ":".join(parts)
    if kind == "email":
        lower = "".join(c.upper() if o.isupper() else c for c, o in zip(new, old)) + new[len(old) :]
        return lower if len(new) == len(old) else new
    return new.upper() if old.isupper() and len(old) > 1 else new[:1].upper() + new[1:]


def replace_entities(text: str, named: Callable[[str, str], str]) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with surrogates, and kind, start and end of each in the new text."""
    out, spans, at, size = [], [], 0, 0
    for start, end, kind, value in find_entities(text):
        new = written(kind, text[start:end], named(kind, value))
        size += start - at
        spans.append((kind, size, size + len(new)))
        out += [text[at:start], new]
        size, at = size + len(new), end
    return "".join([*out, text[at:]]), spans


# --- over the corpus ---------------------------------------------------------------------


def distinct_entities(docs: DataFrame) -> DataFrame:
    """kind and value of all entities, each once."""
    schema = pa.schema([("kind", pa.string()), ("value", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {e[2:] for text in batch.column(0).to_pylist() for e in find_entities(text)}
            kinds, values = zip(*sorted(found)) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], schema=schema)

    return docs.select("text").where("text IS NOT NULL").mapInArrow(task, "kind string, value string").distinct()


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, value, attempt and surrogate, without two equal surrogates of a kind.

    No surrogate of a kind is a value of that kind in the corpus either.
    """
    schema = "kind string, value string, attempt long, surrogate string"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "value", "attempt")))
            new = pa.array([surrogate(key, *r) for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], new], names=["kind", "value", "attempt", "surrogate"])

    entities = stored(entities, "entities")
    state = entities.withColumn("attempt", F.lit(0).cast("long"))
    originals = entities.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
    # the one that was there first keeps its surrogate, so that later rounds disturb nothing
    place = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("attempt", "value"))
    for _ in range(ATTEMPTS):
        drawn = state.select("kind", "value", "attempt").mapInArrow(task, schema)
        judged = stored(
            drawn.withColumn("place", place)
            .join(originals, ["kind", "surrogate"], "left")
            .select("kind", "value", "attempt", "surrogate", ((F.col("place") > 1) | F.coalesce("real", F.lit(False))).alias("clash")),
            "surrogates",
        )
        if not judged.where("clash").limit(1).count():
            return judged.drop("clash")
        state = judged.withColumn("attempt", F.col("attempt") + F.col("clash").cast("long"))
    raise ValueError(f"surrogates still collide after {ATTEMPTS} attempts")


def with_surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """docs with surrogates in text, and a column entities: kind, start and end of each in the new text."""
    small_batches(docs.sparkSession)
    later = assign(distinct_entities(docs), key).where("attempt > 0")
    told = later.limit(TOLD + 1).collect()
    columns = docs.columns
    if len(told) <= TOLD:
        known = {(r.kind, r.value): r.surrogate for r in told}
        return _replaced(docs.withColumn("_own", F.lit(None).cast("array<struct<kind:string,value:string,surrogate:string>>")), columns, key, known)
    # too many to hand to every task: each document gets those of its own entities
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    entity = "array<struct<kind:string,value:string>>"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": k, "value": v} for k, v in sorted({e[2:] for e in find_entities(t)})] for t in batch.column(1).to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["_row", "e"])

    holds = (
        keyed.where("text IS NOT NULL").select("_row", "text").mapInArrow(task, f"_row long, e {entity}")
        .select("_row", F.explode("e").alias("e")).select("_row", "e.kind", "e.value").distinct()
    )
    own = holds.join(later, ["kind", "value"]).groupBy("_row").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("_own"))
    return _replaced(keyed.join(own, "_row", "left"), columns, key, {})


def _replaced(docs: DataFrame, columns: list[str], key: bytes, known: dict[tuple[str, str], str]) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name in columns]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "entities array<struct<kind:string,start:long,end:long>>"])
    at = columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                texts, spans = [], []
                for text, own in zip(part.column(at).to_pylist(), part.column(len(columns)).to_pylist()):
                    later = {(o["kind"], o["value"]): o["surrogate"] for o in own} if own else known
                    new, found = (None, []) if text is None else replace_entities(text, lambda k, v, m=later: m.get((k, v)) or surrogate(key, k, v))
                    texts.append(new)
                    spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                out = [part.column(k) for k in range(len(columns))]
                out[at] = pa.array(texts, out[at].type)
                yield pa.RecordBatch.from_arrays([*out, pa.array(spans, span)], names=[*columns, "entities"])

    return docs.select(*(F.col(f"`{c}`") for c in columns), "_own").mapInArrow(task, ddl)


QUERY_KEY = b"a key for the registered query; a real run passes its own"


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    listed = F.array_join(F.transform("entities", lambda e: F.concat_ws(":", e["kind"], e["start"], e["end"])), ",")
    return with_surrogates(docs, QUERY_KEY).select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), listed.alias("spans"))
