"""Problem 2: personal information in free text: find it, mask it, or replace it by keyed surrogates.

Detection works on offsets in code points. Kinds are sought in the order e-mail, account, national id, card, phone,
address, person, and a later kind never overlaps an earlier one. Numbers are told apart by their form, their check digits
and the words before them; names by a lexicon of given names and surnames, by the parts surnames are made of (learned
from the lexicon), and, for names in no lexicon, by titles and the words that introduce a person. Time is linear in the text.

Surrogates keep type, format, letter case, script, check digits and the gender a given name shows. They are derived with a
key, which has no default, name part by name part: a surname has one surrogate in all names and addresses of mailboxes, an
initial is the first letter of every given name that begins with it. A distributed count finds parts (names in persons and in
mailboxes, names of streets) and then whole values of other kinds whose surrogate is another one's or a real one; all but one of
them are derived again, so that distinct people stay distinct and mentions of one stay one. What is counted is what is written.
House numbers need no count: on each street they are permuted.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
import unicodedata
from bisect import bisect_left
from collections import ChainMap

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import durable, release, ship, table

KINDS = ("email", "iban", "national_id", "card", "phone", "address", "person")
#: Bound of the lexicon that is sent to all executors.
LEXICON_ROWS = 200_000

_W = "[\\s​‌‍﻿]"  # blanks, and invisible marks that stand among them
_AT = rf"(?:@|{_W}@{_W}|{_W}*[\[(]{_W}*at{_W}*[\])]{_W}*)"
_DOT = rf"(?:\.|{_W}*[\[(]{_W}*dot{_W}*[\])]{_W}*)"
_LABEL = r"[^\W_](?:[\w-]*[^\W_])?"
_LOCAL = r"(?<![\w.%+-])[^\W_][\w.%+-]*"
_EMAIL = re.compile(rf"{_LOCAL}{_AT}{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[^\W\d_]{{2,}}(?![^\W_])", re.I)
_EMAIL_WORDS = re.compile(rf"{_LOCAL}{_W}at{_W}{_LABEL}(?:{_W}dot{_W}{_LABEL})+(?![^\W_])", re.I)

#: Lengths of account numbers by country (public registry).
IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 "
    "KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
).split()}
_IBAN = re.compile(rf"(?<![A-Za-z0-9])([A-Za-z]{{2}})\d{{2}}(?:(?:{_W}|-)?[A-Za-z0-9]){{10,31}}")
_ACCOUNT = re.compile(r"account|deposit|iban|geht auf|konto|cuenta|vers|compte|conto|rekening", re.I)

_ID_WORDS = re.compile(
    r"(?:social\s+security|national\s+insurance|insurance|tax(?:payer)?|passport|identity(?:\s+card)?|id(?:entification)?(?:\s+card)?)\s+(?:number|no\b\.?|id)"
    r"|num[ée]ro\s+(?:de\s+)?(?:s[ée]curit[ée]\s+sociale|passeport|fiscal|carte\s+d.identit[ée])"
    r"|\bSSN\b|\bNINO\b|\bPESEL\b|\bCPF\b|\bNHS\s+(?:number|no\b\.?)"
    r"|\b(?:DNI|NIF|NIE)\b|pasaporte(?:\s+n[úu]mero)?|n[úu]mero\s+de\s+(?:seguridad\s+social|pasaporte|identidad)"
    r"|(?:personal)?ausweisnummer|steuer-?(?:id(?:entifikationsnummer)?|nummer)|sozialversicherungsnummer|(?:reise)?passnummer"
    r"|codice\s+fiscale|numero\s+di\s+passaporto|burgerservicenummer|\bBSN\b|paspoortnummer",
    re.I,
)
_ID_VALUE = re.compile(rf"(?:{_W}|[:,])*(?:(?:is|was|est|es|lautet|ist|war|e|è|le|la|el|de){_W}+)*(?:{_W}|[:,])*((?:[A-Z]{{1,2}}(?:{_W}|-)?)?\d[\dA-Z]*(?:(?:{_W}|[.-])\d+)*(?:(?:{_W}|-)?[A-Z](?![A-Za-z0-9]))?)", re.I)

_CARD = re.compile(r"(?<![\dA-Za-z+])(?<!\d[ .-])\d(?:[ -]?\d){12,18}(?![\dA-Za-z])(?![ -]\d)")
_CARD_WORDS = re.compile(r"card|karte|carte|tarjeta|carta|kaart|visa|mastercard|amex", re.I)
_OTHER_NUMBER = re.compile(r"(?:invoice|order|part|serial|version|shelf|ref(?:erence)?|rechnung|facture|factura|bestell\w*|commande|pedido|fattura|ordine|factuur|sku|item|model|isbn)[\w ]{0,14}(?:no\.|nr\.|number|mark|:|#|is|was)?\W*$", re.I)

_PHONE = re.compile(
    r"(?<![\w.+/-])(?:"
    r"\+\d{1,3}(?:[ .-]?\(0\))?(?:[ ./-]?\(?\d{1,5}\)?){1,6}"
    r"|(?:1[ .-])?\([2-9]\d{2}\)[ .-]?\d{3}[ .-]\d{4}"
    r"|(?:1[ .-])?[2-9]\d{2}([ .-])\d{3}\1\d{4}"
    r"|\(?0\d{1,5}\)?[ ./-]\d{2,8}(?:[ .-]\d{2,5}){0,4}"
    r"|[6-9]\d{1,2}([ .-])\d{3}(?:\2\d{2}\2\d{2}|\2\d{3})"
    r")(?![\w])(?!-\d)(?!\.\d)"
)
_PHONE_BARE = re.compile(r"(?:\btel(?:efon\w*|[ée]phone|\.)?|\bphone|\bcall|\bring|\btext me on|appelez le|llame al|rufen sie|\bT:|☎)[ :.]*(\d{9,12})(?!\d)", re.I)

#: Words of street addresses.
_EN_STREET = "Road|Rd|Street|St|Avenue|Ave|Lane|Ln|Drive|Dr|Court|Ct|Close|Boulevard|Blvd|Way|Place|Pl|Square|Sq|Terrace|Crescent|Cres|Gardens|Grove|Hill|Mews|Row|Walk|Parkway|Pkwy|Highway|Hwy|Circle|Alley|Quay|Wharf"
_UNIT = r"(?:Flat|Apt|Apartment|Unit|Suite|Ste)\.?"
_NAME = r"[^\W\d_][^\W\d_'’-]*(?:-[^\W\d_]+)?"
_DE_END = "straße|strasse|str\\.|weg|platz|allee|gasse|ufer|ring|damm"
_ADDRESS = [
    re.compile(rf"(?<![\w.,-])(?:{_UNIT}{_W}\d+[A-Z]?,?{_W})?\d{{1,5}}[A-Z]?{_W}(?:[NSEW]\.?{_W})?(?P<n>(?:{_NAME}{_W}){{1,2}})(?:{_EN_STREET})\b\.?(?:,{_W}{_UNIT}{_W}?\d*[A-Z]?\d*[A-Z]?)?", re.I),
    re.compile(rf"(?<![\w.,-])\d{{1,4}}(?:{_W}?(?:bis|ter|quater))?,?{_W}(?:rue|avenue|place|boulevard|bd|chemin|impasse|all[ée]e|quai|route|cours){_W}(?:(?:de{_W}la|du|des|de|la|le){_W}|d['’]|de{_W}l['’])?(?P<n>{_NAME})(?:,{_W}(?:appt|appartement|b[âa]t)\.?{_W}\d+\w?)?", re.I),
    re.compile(rf"(?<![\w-])(?P<n>[^\W\d_]+?)(?:{_DE_END}){_W}\d{{1,4}}(?:[a-z])?\b(?:,{_W}(?:whg|wohnung)\.?{_W}\d+)?", re.I),
    re.compile(rf"(?<![\w-])(?:Am|An{_W}der|An{_W}den|Auf{_W}dem|Auf{_W}der|Im|In{_W}der|Zum|Zur|Unter{_W}den){_W}(?P<n>{_NAME}){_W}\d{{1,4}}[a-z]?\b", re.I),
    re.compile(rf"(?<![\w-])(?:C/|Calle|Avenida|Avda\.?|Av\.|Plaza|Paseo|Camino|Ronda|Carrera|Travesía){_W}?(?:(?:de{_W}la|del|de{_W}los|de){_W})?(?P<n>{_NAME}),?{_W}(?:n\.?º{_W}?)?\d{{1,4}}[A-Z]?\b(?:,{_W}(?:piso|apto)\.?{_W}\d+\w?)?", re.I),
    re.compile(rf"(?<![\w-])(?:Via|Viale|Piazza|Corso|Vicolo|Largo){_W}(?:(?:della|del|dei|di){_W})?(?P<n>{_NAME}),?{_W}\d{{1,4}}\w?\b", re.I),
    re.compile(rf"(?<![\w-])(?P<n>[^\W\d_]+?)(?:straat|laan|plein|gracht|kade|dreef|singel){_W}\d{{1,4}}[a-z]?\b", re.I),
]

#: Titles before a name, and words that stand before a surname without being a given name.
_TITLES = frozenset("mr mrs ms miss dr prof sir madam mister herr frau fräulein monsieur madame mademoiselle m mme mlle señor señora señorita senor senora senorita sr sra srta don doña signor signora signorina sig sigra dottor dott ing meneer mevrouw dhr mw".split())
_NOT_GIVEN = frozenset(
    "the a an and or of to for by in on at with from as if but so that this his her our their my your he she it we they i is was are were be can holder reach nach por demandez und et y e o le la les el los las il lo de du des der die das den dem ein eine un une una una del della van het een en na per pour par con chez vers sur sous name applicant ask call according led asked said met saw mail tel then when where who with without after before near meeting chapter report signed wrote"
    .split()
)
_INITIAL = re.compile(r"[^\W\d_]\.$")
_FEMALE = re.compile(r"(?:a|e|y|is|lot|ine|elle)$", re.I)


def _luhn(d: str) -> bool:
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 * (x > 9)
    return s % 10 == 0


def _mod97(x: str) -> int:
    return int("".join(str(int(c, 36)) for c in (x[4:] + x[:4]).upper())) % 97


class Names:
    """What the lexicon knows, and what surnames are made of. Look-ups take time by the length of a word alone."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.given = frozenset(n.lower() for n, k in rows if k == "given")
        self.surnames = frozenset(n.lower() for n, k in rows if k == "surname")
        ends: dict[str, set[str]] = {}
        for s in self.surnames:
            for i in range(2, len(s) - 2):
                ends.setdefault(s[i:], set()).add(s[:i])
        common = {e: b for e, b in ends.items() if len(b) >= 5}
        begins: dict[str, set[str]] = {}
        for e, bs in common.items():
            for b in bs:
                begins.setdefault(b, set()).add(e)
        # beginnings that occur with three ends or more; of ends that contain each other the longer is one with the shorter
        self.begins = frozenset(b for b, es in begins.items() if sum(not any(e[i:] in es and b + e[:i] in begins for i in range(1, len(e) - 1)) for e in es) >= 3)
        self.ends = frozenset(e for e, bs in common.items() if sum(x in self.begins for x in bs) >= 5)

    def surname(self, low: str) -> bool:
        return low in self.surnames or any(low[i:] in self.ends and low[:i] in self.begins for i in range(2, len(low) - 1))


class _Spans:
    """Disjoint stretches, kept in order; one that overlaps an earlier one is left out."""

    def __init__(self):
        self.starts: list[int] = []
        self.rows: list[tuple[int, int, str]] = []

    def add(self, start: int, end: int, kind: str) -> None:
        i = bisect_left(self.starts, end)
        if start < end and (not i or self.rows[i - 1][1] <= start):
            self.starts.insert(i, start)
            self.rows.insert(i, (start, end, kind))


#: A word of a name, hyphened ones in one, no part of an address or a number.
_NAME_WORD = re.compile(r"(?<![\w@.%+-])[^\W\d_]+(?:['’][^\W\d_]+)*(?:-[^\W\d_]{2,})*(?![\w@%+]|[-.][\w])")
#: The same, of those that begin with a capital (letters of other alphabets pass either way).
_CAPITAL_WORD = re.compile(_NAME_WORD.pattern.replace("(?<![\\w@.%+-])", "(?<![\\w@.%+-])(?=[^\\W\\d_a-zß-öø-ÿ])"))
_LAST_WORD = re.compile(rf"([^\W\d_]+)\.?{_W}+$")
_BETWEEN = re.compile(rf"{_W}+$")
#: Words that introduce a person, for names in no lexicon.
_CUES = frozenset("met named contact applicant attorney witness".split())


def _capital(w: str) -> bool:
    return w[:1].isupper()


def _persons(t: str, names: Names, out: _Spans, cased: bool) -> None:
    # in a text with capitals only words with one are looked at; small words before them are read where they matter
    words = [(m.start(), m.end(), m.group()) for m in (_CAPITAL_WORD if cased else _NAME_WORD).finditer(t)]
    low = [w.lower() for _, _, w in words]
    first = [x.split("-")[0] for x in low]
    n = len(words)

    def gap(i: int) -> str:
        """What stands between the words i - 1 and i."""
        return t[words[i - 1][1] : words[i][0]] if i else t[: words[0][0]]

    def initial(i: int) -> bool:
        """Is the word i an initial with its point?"""
        return len(words[i][2]) == 1 and t[words[i][1] : words[i][1] + 1] == "."

    def apart(i: int) -> bool:
        """Are the words i - 1 and i parted by blanks alone, or by an initial's or a title's point and blanks?"""
        g = gap(i)
        return bool(g) and (g.isspace() or _BETWEEN.fullmatch(g) is not None or (g[0] == "." and len(g) > 1 and _BETWEEN.fullmatch(g[1:]) is not None and (initial(i - 1) or low[i - 1] in _TITLES)))

    def small(i: int) -> str:
        """The word without a capital right before the word i, if there is one."""
        m = _LAST_WORD.search(t, max(0, words[i][0] - 40), words[i][0]) if cased else None
        return m.group(1).lower() if m and not _capital(m.group(1)) else ""

    taken = cued = -1  # the last word of the name before, and of the last one that was introduced
    for i in range(n):
        s, e, w = words[i]
        if i <= taken or (cased and not _capital(w)):
            continue
        if not initial(i) and (low[i] in names.surnames or names.surname(first[i])):
            at, title, start, began = i, False, None, None
            if i and apart(i) and initial(i - 1) and "\n" not in gap(i):
                began = at = i - 1
            p = at - 1
            if at and apart(at) and p > taken:
                word = words[p][2]
                if low[p] in _TITLES:
                    title = True
                elif low[p] in names.given:
                    start = words[p][0]
                elif "\n" not in gap(at) and len(word) > 1 and low[p] not in _NOT_GIVEN and (_capital(word) or not cased) and not (low[p] in names.surnames or names.surname(first[p])) and gap(at)[0] != ".":
                    start = words[p][0]
            if start is None and not title:
                title = small(at) in _TITLES
            if start is not None:
                out.add(start, e, "person")
                taken = i
                continue
            if i + 1 < n and began is None:
                g, q = gap(i + 1), low[i + 1]
                if g[:1] == "," and len(g) > 1 and _BETWEEN.fullmatch(g[1:]) and len(q) > 1 and (q in names.given or (_capital(words[i + 1][2]) and cased and q not in _NOT_GIVEN and not title)):
                    end, k = words[i + 1][1], i + 1
                    if i + 2 < n and initial(i + 2) and _BETWEEN.fullmatch(gap(i + 2)):
                        end, k = words[i + 2][1] + 1, i + 2
                    more = k + 1 < n and apart(k + 1) and names.surname(first[k + 1]) and (_capital(words[k + 1][2]) or not cased)
                    if not (more and q not in names.given):
                        out.add(s, end, "person")
                        taken = k
                        continue
            if title or began is not None:
                out.add(words[began][0] if began is not None else s, e, "person")
                taken = i
            continue
        if not cased or i + 1 >= n:
            continue
        if low[i] in names.given:
            k = i + 1
            if apart(k) and initial(k) and k + 1 < n:
                k += 1
            if apart(k) and _capital(words[k][2]) and len(words[k][2]) > 2 and low[k] not in _NOT_GIVEN and low[k] not in names.given and not (names.surname(first[k])):
                out.add(s, words[k][1], "person")
                taken = k
        elif low[i] in _TITLES and len(w) > 1 and apart(i + 1) and "\n" not in gap(i + 1):
            k = _unknown(words, low, names, apart, initial, i + 1, low[i] in _ONE_NAME)
            if k is not None:
                out.add(words[i + 1][0], words[k][1], "person")
                taken = k
        elif t[s - 1 : s] == " " and ((w := t[max(0, s - 12) : s].split(" ")[-2]) in _CUES or (w == "and" and taken == i - 1 and cued == taken >= 0 and gap(i) == " and ")):
            k = _unknown(words, low, names, apart, initial, i, False)
            if k is not None and k > i and "\n" not in t[s : words[k][1]]:  # a given name and a surname at least
                out.add(s, words[k][1], "person")
                taken = cued = k


#: Titles of languages whose nouns have capitals, after which one word is the name.
_ONE_NAME = frozenset("herr frau".split())


def _unknown(words, low, names: Names, apart, initial, i: int, one: bool) -> int | None:
    """The last word of a name in no lexicon that begins at the word i, after a title; None if there is none."""
    k = i
    while k + 1 < len(words) and initial(k) and apart(k + 1):
        k += 1
    if initial(k) or not _capital(words[k][2]) or len(words[k][2]) < 3 or low[k] in _NOT_GIVEN or words[k][2].isupper():
        return None
    more = k + 1
    if more < len(words) and apart(more) and initial(more) and more + 1 < len(words):
        more += 1
    if more < len(words) and apart(more) and not (one and low[k] not in names.given and not names.surname(low[more].split("-")[0])) and _capital(words[more][2]) and len(words[more][2]) > 2 and low[more] not in _NOT_GIVEN:
        return more
    return k


def find(t: str | None, names: Names) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the values of a text, by place."""
    if not t:
        return []
    out = _Spans()
    low = t.lower()
    cased = not (t.isupper() or low == t)
    runs = [m.span() for m in _DIGITS.finditer(t)]
    digits = sum(e - s for s, e in runs)
    if "@" in t or _AT_SIGN.search(low):
        for m in _EMAIL.finditer(t):
            out.add(*m.span(), "email")
        if " dot " in low or "\ndot" in low or "dot\n" in low:
            for m in _EMAIL_WORDS.finditer(t):
                out.add(*m.span(), "email")
    if digits >= 8:
        for m in _IBAN.finditer(t):
            n = IBAN_LENGTHS.get(m.group(1).upper())
            if not n:
                continue
            got, end = 0, m.start()
            while end < m.end() and got < n:
                got += t[end].isalnum()
                end += 1
            if got < n or t[end : end + 1].isalnum():
                continue
            x = "".join(c for c in t[m.start() : end] if c.isalnum())
            if sum(c.isdigit() for c in x) >= n // 2 and (_mod97(x) == 1 or _ACCOUNT.search(t[max(0, m.start() - 40) : m.start()])):
                out.add(m.start(), end, "iban")
    if digits >= 5 and any(w in low for w in _ID_GATE):
        for m in _ID_WORDS.finditer(t):
            v = _ID_VALUE.match(t, m.end())
            if v and sum(c.isdigit() for c in v.group(1)) >= 5:
                out.add(*v.span(1), "national_id")
    if digits >= 8:
        for a, b in _windows(runs, 8, 24):
            for m in _CARD.finditer(t, a, b):
                d = "".join(c for c in m.group() if c.isdigit())
                left = t[max(0, m.start() - 40) : m.start()]
                if 13 <= len(d) <= 19 and not _OTHER_NUMBER.search(left) and (_luhn(d) or _CARD_WORDS.search(left)):
                    out.add(*m.span(), "card")
            for m in _PHONE.finditer(t, a, b):
                n = sum(c.isdigit() for c in m.group())
                end = m.end() - (not m.group()[-1].isdigit())
                if 8 <= n <= 15 and not _OTHER_NUMBER.search(t[max(0, m.start() - 30) : m.start()]):
                    out.add(m.start(), end, "phone")
            for m in _PHONE_BARE.finditer(t, max(0, a - 20), b):
                out.add(*m.span(1), "phone")
    if digits:
        for a, b in _windows([r for r in runs if r[1] - r[0] <= 5], 1, 60):
            part = low[a:b] if len(low) == len(t) else t[a:b].lower()
            for gate, r in zip(_STREET_GATE, _ADDRESS):
                if any(w in part for w in gate):
                    for m in r.finditer(t, a, b):
                        if not cased or all(_capital(w) for w in m.group("n").split()):
                            out.add(*m.span(), "address")
    _persons(t, names, out, cased)
    return out.rows


_DIGITS = re.compile(r"\d+")
_AT_SIGN = re.compile(r"[\[(]\s*at\s*[\])]|\bdot\b")
_ID_GATE = ("number", "no.", "numéro", "numero", "número", "dni", "nif", "nie", "ausweis", "steuer", "pass", "pasaporte", "codice", "bsn", "nummer", " id", "ssn", "nino", "pesel", "cpf")
#: What a text must hold for each of the address forms.
_STREET_GATE = [
    [" " + w.lower() for w in _EN_STREET.split("|")],
    ["rue", "avenue", "place", "boulevard", "bd", "chemin", "impasse", "all", "quai", "route", "cours"],
    ["str", "weg", "platz", "allee", "gasse", "ufer", "ring", "damm"],
    ["am ", "an d", "auf d", "im ", "in der", "zum ", "zur ", "unter den"],
    ["c/", "calle", "aven", "av", "plaza", "paseo", "camino", "ronda", "carrera", "traves"],
    ["via", "piazza", "corso", "vicolo", "largo"],
    ["straat", "laan", "plein", "gracht", "kade", "dreef", "singel"],
]


def _windows(runs: list[tuple[int, int]], least: int, side: int) -> list[tuple[int, int]]:
    """Stretches around runs of digits, those that come near each other joined; at least so many digits in each."""
    out: list[list[int]] = []
    for s, e in runs:
        if out and s - side <= out[-1][1]:
            out[-1][1] = e + side
            out[-1][2] += e - s
        else:
            out.append([max(0, s - side), e + side, e - s])
    return [(a, b) for a, b, n in out if n >= least]


def lexicon(df: DataFrame) -> list[tuple[str, str]]:
    """The names of a lexicon table, at most ``LEXICON_ROWS``; more is an error rather than a loss."""
    rows = df.where("name_text is not null").select("name_text", "name_kind").distinct().limit(LEXICON_ROWS + 1).collect()
    if len(rows) > LEXICON_ROWS:
        raise ValueError(f"the lexicon has more than {LEXICON_ROWS} names")
    return sorted((r[0], r[1]) for r in rows)


_BUILT: dict[int, Names] = {}


def _names(rows) -> Names:
    k = hash(tuple(rows))
    if k not in _BUILT:
        _BUILT[k] = Names(rows)
    return _BUILT[k]


def _find_rows(rows):
    def run(frames):
        names = _names(rows)
        for f in frames:
            out = [(d, s, e, k) for d, t in zip(f["doc_id"], f["text"]) for s, e, k in find(t, names)]
            yield pd.DataFrame(out, columns=["doc_id", "start_at", "end_at", "pii_type"])

    return run


def spans(df: DataFrame, names: list[tuple[str, str]], id_col: str = "doc_id", text_col: str = "text_deep_clean") -> DataFrame:
    """``doc_id, start_at, end_at, pii_type`` of every value found.

    Null and empty texts and rows without an id give no row; very long texts are searched to their end.
    """
    ship(df.sparkSession)
    src = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null and text <> ''")
    return src.mapInPandas(_find_rows(names), "doc_id string, start_at bigint, end_at bigint, pii_type string")


def replaced(t: str | None, parts: list[tuple[int, int, str]]) -> str | None:
    """A text with some stretches replaced."""
    if not t:
        return t
    out, at = [], 0
    for s, e, x in sorted(parts):
        out += [t[at:s], x]
        at = e
    return "".join([*out, t[at:]])


# ---- surrogates


def normal(kind: str, v: str) -> str:
    """A value without its spelling: what two mentions of one thing share."""
    v = re.sub("[​‌‍﻿]", "", v)
    if kind == "email":
        v = re.sub(r"\s*[\[(]\s*at\s*[\])]\s*|\s+at\s+|\s*@\s*", "@", v, flags=re.I)
        return re.sub(r"\s*[\[(]\s*dot\s*[\])]\s*|\s+dot\s+", ".", v, flags=re.I).lower()
    if kind in ("phone", "card", "iban", "national_id"):
        n = "".join(c for c in v if c.isalnum()).upper()
        # a number with 1 and ten digits is written with and without the plus
        return "+" + n if kind == "phone" and (v[:1] == "+" or (len(n) == 11 and n[0] == "1")) else n
    if kind == "person" and "," in v:
        v = " ".join(reversed(v.split(",", 1)))
    return " ".join(re.findall(r"[^\W_]+", v.lower()))


_ONSET = "b br d dr f g gr h j k kr l m n p pr r s st t tr v w z".split()
_VOWEL = "a e i o u ai ei".split()
#: Letters of scripts with vowels and consonants apart, and ranges of others.
_LETTERS = {"CYRILLIC": ("бвгджзклмнпрст", "аеиоу"), "GREEK": ("βγδζκλμνπρστ", "αειοη"), "ARMENIAN": ("բգդզլկհմնպրստ", "աեիոու"), "GEORGIAN": ("ბგდვზთკლმნპრსტ", "აეიოუ")}
_RANGES = {"HEBREW": (0x5D0, 0x5EA), "ARABIC": (0x627, 0x63A), "DEVANAGARI": (0x915, 0x939), "HIRAGANA": (0x304B, 0x3082), "KATAKANA": (0x30AB, 0x30E2), "HANGUL": (0xAC00, 0xD7A3), "CJK": (0x4E00, 0x9FA5), "THAI": (0xE01, 0xE2E)}
#: Letters that names begin with, without marks.
_ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшщэюя", "αβγδεζηθικλμνξοπρστυφχψω", "".join(map(chr, range(0x561, 0x587))), "".join(map(chr, range(0x10D0, 0x10F1))))
#: Common given names by the gender they show. Names in neither show theirs by no ending but -a.
_MALE = frozenset("luca andrea nicola mattia elia gianluca nikita ilya sasha misha joshua noah ezra philippe mike steve george james charles joe pete dave jake luke kyle blake wayne andre antoine etienne pierre jacques guillaume jerome maxime stephane gilles yves jules alexandre baptiste thomas lukas jonas matthias tobias andreas markus klaus hans carlos luis jesus marcos lucas nicolas matteo davide daniele michele gabriele emanuele simone giuseppe salvatore felipe jorge jose vicente enrique jaime".split())
_WOMEN = frozenset("mary margaret elizabeth susan karen helen ruth carol sharon ann anne jane alice claire marie sophie julie nathalie isabelle catherine christine brigitte ingrid astrid birgit heike ute elke carmen dolores mercedes pilar rocio isabel raquel beatriz irene agnes edith judith esther miriam doris ingeborg hedwig gertrud".split())


def script(word: str) -> str:
    return unicodedata.name(word[0], "LATIN").split()[0]


def shown_gender(given: str) -> str:
    """``f``, ``m`` or, where a name shows none, ``n``."""
    low = given.lower()
    return "m" if low in _MALE else "f" if low in _WOMEN or (low[-1:] in "aаα" and len(low) > 2) else "n"


def _stream(key: bytes, *what) -> "np.random.Generator":
    d = hmac.new(key, "\u0001".join(map(str, what)).encode(), hashlib.sha256).digest()
    return np.random.default_rng(np.frombuffer(d, np.uint64))


def _like(word: str, new: str) -> str:
    return new.upper() if word.isupper() and len(word) > 1 else new.lower() if word.islower() else new.capitalize()


def _alphabet(letter: str) -> str:
    """The alphabet of a small letter without marks; empty if it is in none, as then it is no initial but a name of its own."""
    return next((x for x in _ALPHABETS if letter in x), "")


def _first_letter(key: bytes, letter: str) -> str:
    """The letter that stands for an initial: a keyed permutation of the alphabet, so that two initials stay two."""
    alphabet = _alphabet(base := unicodedata.normalize("NFKD", letter)[0])
    return alphabet[int(_stream(key, "initials", *[script(base)] * (base > "z")).permutation(len(alphabet))[alphabet.index(base)])] if alphabet else letter


def _number(key: bytes, digits: str, *what) -> str:
    """Digits in place of digits: for each ``what`` a keyed permutation of the numbers of one length, so that two stay two."""
    stem = digits.lstrip("0")
    if not stem:
        return digits
    low = 10 ** (len(stem) - 1)
    half = max(2, ((9 * low).bit_length() + 1) // 2)  # a Feistel network on the next even number of bits, walked until in range
    x = int(stem) - low
    while True:
        a, b = x >> half, x & ((1 << half) - 1)
        for i in range(6):
            d = hmac.new(key, "\u0001".join(map(str, ("number", *what, low, i, b))).encode(), hashlib.sha256).digest()
            a, b = b, a ^ (int.from_bytes(d) & ((1 << half) - 1))
        x = a << half | b
        if x < 9 * low:
            return digits[: len(digits) - len(stem)] + str(low + x)


_CACHE: dict = {}


def new_part(key: bytes, role: str, word: str, attempt: int = 0) -> str:
    """The surrogate, in small letters, of a part of a name or street: ``role`` is given, surname or street."""
    at = (key, role, word, attempt)
    if at in _CACHE:
        return _CACHE[at]
    low = word.lower()
    r, sc = _stream(key, role, low, attempt), script(low)
    if sc in _RANGES:
        lo, hi = _RANGES[sc]
        new = "".join(chr(int(r.integers(lo, hi + 1))) for _ in range(max(2, len(low))))
    else:
        onset, vowel = _LETTERS.get(sc, (_ONSET, _VOWEL))
        new = "".join(onset[r.integers(len(onset))] + vowel[r.integers(len(vowel))] for _ in range(4))
        if role == "given":
            first = _first_letter(key, low[0])
            new = first + (new[1:] if first in vowel and new[0] in onset else "".join(new.partition(next(c for c in new if c in "".join(vowel)))[1:]) if first not in vowel else new)
            a, n = ("а", "н") if sc == "CYRILLIC" else ("α", "ν") if sc == "GREEK" else ("na", "n")
            new += {"f": a, "m": n, "n": ""}[shown_gender(low)]
        elif sc == "LATIN":
            new += {"surname": "mer", "street": "field"}[role]
    if len(_CACHE) > 500_000:
        _CACHE.clear()
    _CACHE[at] = new
    return new


#: Check letters of Spanish identity numbers.
_DNI = "TRWAGMYFPDXBNJZSQVHLCKE"


def name_parts(value: str) -> list[tuple[int, int, str]]:
    """(start, end, role) of the words of a name: given, surname or initial."""
    words = [m.span() for m in re.finditer(r"[^\W\d_]+", value)]
    comma = value.find(",")
    last = [i for i, (s, _) in enumerate(words) if s < comma] if comma >= 0 else [len(words) - 1]
    while comma < 0 and last[0] > 0 and value[words[last[0]][0] - 1] == "-":  # a surname of two hyphened ones
        last.insert(0, last[0] - 1)
    return [(s, e, "surname" if i in last else "initial" if e - s == 1 and _alphabet(unicodedata.normalize("NFKD", value[s].lower())[0]) else "given") for i, (s, e) in enumerate(words)]


def street_parts(value: str) -> list[tuple[int, int]]:
    """(start, end) of the words of an address that name its street in any reading; of a text that is no address, of all its words."""
    read = [m.span("n") for r in _ADDRESS if (m := r.fullmatch(value))]
    return sorted({w.span() for a, b in read or [(0, len(value))] for w in re.compile(r"[^\W\d_]+").finditer(value, a, b)})


#: Roles of the parts of names; all other roles are kinds, whose values are replaced as a whole.
PARTS = ("given", "surname", "street")


def parts_of(kind: str, value: str, roles=None) -> list[tuple[str, str]]:
    """What of a value gets a surrogate of its own: (role, normal form) of name parts, of the names of streets, or of the
    whole of another kind; of an address of a mailbox both the whole and the names in it, which ``roles`` knows.

    Initials and the numbers of addresses are permuted, so they need no count.
    """
    if kind == "person":
        return [(role, value[s:e].lower()) for s, e, role in name_parts(value) if role != "initial"]
    if kind == "address":
        return [("street", value[s:e].lower()) for s, e in street_parts(value)]
    n = normal(kind, value)
    named = _MAILBOX.findall(n.split("@")[0]) if kind == "email" and roles else []
    return [(kind, n), *((role, w) for w in named if (role := roles(w)))]


_MAILBOX = re.compile(r"[^\W\d_]+|\d{1,18}|[\W_]")


def surrogate(kind: str, value: str, key: bytes, attempts=None, roles=None) -> str:
    """A replacement of the same kind and form, the same for every mention of the value under one key.

    ``attempts`` gives the number of the attempt for a (role, normal form) of ``parts_of`` where it is not the first.
    ``roles`` tells for a lower-cased word whether it is a given name or a surname, for names within addresses of mailboxes.
    """
    tried = attempts or {}
    n = normal(kind, value)
    again = tried.get((kind, n), 0)
    part = lambda role, w: new_part(key, role, w, tried.get((role, w.lower()), 0))
    if kind == "person":
        out, at = [], 0
        for s, e, role in name_parts(value):
            w = value[s:e]
            new = _first_letter(key, w.lower()) if role == "initial" else part(role, w)
            out += [value[at:s], new.upper() if role == "initial" and w.isupper() else _like(w, new)]
            at = e
        return "".join([*out, value[at:]])
    r = _stream(key, kind, n, again)
    if kind == "email":
        local, _, domain = n.partition("@")
        known = roles or (lambda w: None)
        words = _MAILBOX.findall(local)
        at = [w for w in words if not w.isdecimal()]
        syllables = lambda n, r: "".join(_ONSET[r.integers(len(_ONSET))] + _VOWEL[r.integers(len(_VOWEL))] for _ in range(n))
        new = "".join(part(role, w) if (role := known(w)) else w if not w[:1].isalnum() else _number(key, w, "mailbox", *at) if w.isdecimal() else _first_letter(key, w) if len(w) == 1 else syllables(3, r) for w in words)
        # more digits with each attempt: of one name's mailboxes there may be any number
        new += str(r.integers(10 ** (again + 1), 10 ** (again + 2))) if again or not any(known(w) for w in at) else ""
        r = _stream(key, "domain", domain)
        new += "@" + syllables(4, r) + (".example.org", ".example.net", ".example.com")[r.integers(3)]
        return new.upper() if value.isupper() else new
    if kind in ("phone", "card", "iban", "national_id"):
        plus = n[:1] == "+"
        n = n.removeprefix("+")
        keep = {"iban": 2, "phone": plus + (plus and n[0] not in "17")}.get(kind, 1 if n[:1].isalpha() else 0)  # of the form without spelling, as this is what is counted
        new = [c if i < keep else str(r.integers(10)) if c.isdigit() else chr(65 + r.integers(26)) for i, c in enumerate(n)]
        if kind == "phone" and not plus and n[0] == "0":
            new[0] = "0"
        elif kind in ("phone", "card") and new[keep] == "0":
            new[keep] = "5"
        if kind == "card":
            new[-1] = next(x for x in "0123456789" if _luhn("".join(new[:-1]) + x))
        if kind == "iban":
            new[2:4] = "00"
            new[2:4] = f"{98 - _mod97(''.join(new)):02d}"
        if kind == "national_id":
            if re.fullmatch(r"\d{8}[A-Z]", n) and _DNI[int(n[:8]) % 23] == n[8]:
                new[8] = _DNI[int("".join(new[:8])) % 23]
            elif re.fullmatch(r"[12]\d{14}", n) and (int(n[:13]) + int(n[13:])) % 97 == 0:
                new[0] = n[0]  # it shows the gender
                new[13:] = f"{97 - int(''.join(new[:13])) % 97:02d}"
        it = iter(new)
        out = "".join(next(it) if c.isalnum() else c for c in value)
        return out.lower() if value.islower() else out
    named = street_parts(value)
    street = [value[s:e].lower() for s, e in named]
    out, at = [], 0
    for s, e in [*named, (len(value), len(value))]:
        out += [re.sub(r"\d{1,18}", lambda m: _number(key, m.group(), "street", *street), value[at:s]), _like(value[s:e], part("street", value[s:e])) if e > s else ""]
        at = e
    return "".join(out)


def _render(role: str, word: str, key: bytes, attempt: int, tried=None, roles=None) -> str:
    """The normal form of a part's surrogate; ``tried`` has the attempts of the names within whole values."""
    if role in PARTS:
        return new_part(key, role, word, attempt)
    return normal(role, surrogate(role, word, key, ChainMap({(role, word): attempt}, tried or {}), roles))


def _roles(known: Names):
    """Tells for a lower-cased word whether it is a given name or a surname."""
    return lambda w: "given" if w in known.given else "surname" if len(w) > 3 and known.surname(w) else None


#: Parts that may have to be derived again: collisions of 64-bit-like spaces are few, and this many are a broadcast of 60 MB.
EXCEPTIONS = 1_000_000


def again(parts: DataFrame, key: bytes, rounds: int = 8, make=_render, names=None, tried=None) -> DataFrame:
    """``role, normal, attempt`` of the parts whose first surrogate is that of another part or a real one.

    ``parts``: role, normal. Only the exceptions are kept; each round counts all surrogates anew. After ``rounds`` an error
    is raised. ``names`` and ``tried`` (a lexicon, and a broadcast of its parts' attempts) are for whole values that hold names.
    """
    spark = parts.sparkSession
    values = durable(parts.select("role", "normal").distinct())
    done = spark.createDataFrame([], "role string, normal string, attempt int")

    def render(frames):
        more = {"tried": tried.value, "roles": _roles(_names(names))} if names is not None else {}
        for f in frames:
            yield f.assign(s=[make(k, v, key, int(a), **more) for k, v, a in zip(f["role"], f["normal"], f["attempt"])])[["role", "normal", "attempt", "s"]]

    for _ in range(rounds):
        now = values.join(done, ["role", "normal"], "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
        made = durable(now.mapInPandas(render, "role string, normal string, attempt int, s string"))
        # a surrogate must be no other value's surrogate, and no real value
        first = made.groupBy("role", "s").agg(F.min("normal").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        real = made.join(values.select("role", F.col("normal").alias("s")).hint("merge"), ["role", "s"], "left_semi").select("role", "normal", "attempt")
        clash = made.hint("merge").join(first, ["role", "s"]).where("normal <> first").select("role", "normal", "attempt").union(real).distinct()
        clash = durable(clash.withColumn("attempt", F.col("attempt") + 1))
        release(made)
        if clash.isEmpty():
            return done
        done = durable(done.join(clash, ["role", "normal"], "left_anti").union(clash))
    raise RuntimeError("surrogates still collide; use a longer key")


def surrogates(df: DataFrame, names: list[tuple[str, str]], key: bytes, id_col: str = "doc_id", text_col: str = "text_deep_clean") -> DataFrame:
    """``doc_id, surrogate_text, n_values``: every row with surrogates in place of its values.

    Texts are searched once and written beside the places found; the surrogates are checked over all distinct parts of names,
    then, with these, over all distinct whole values; then the texts are rewritten where they lie, as only the exceptions are
    sent to them. Null texts stay null.
    """
    if not key:
        raise ValueError("surrogates need a key")
    ship(df.sparkSession)

    def search(frames):
        known = _names(names)
        roles = _roles(known)
        for f in frames:
            got = [find(t, known) for t in f["text"]]
            parts = [sorted({p for s, e, k in g for p in parts_of(k, t[s:e], roles)}) for t, g in zip(f["text"], got)]
            yield pd.DataFrame({"doc_id": f["doc_id"], "text": f["text"], "at": [[{"s": s, "e": e, "k": k} for s, e, k in g] for g in got], "parts": [[{"role": r, "normal": n} for r, n in p] for p in parts]})

    src = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    found = durable(src.mapInPandas(search, "doc_id string, text string, at array<struct<s: bigint, e: bigint, k: string>>, parts array<struct<role: string, normal: string>>"))
    parts = durable(found.select(F.explode("parts").alias("p")).select("p.*").distinct())
    sc = df.sparkSession.sparkContext

    def exceptions(redo: DataFrame) -> dict:
        rows = redo.limit(EXCEPTIONS + 1).collect()  # collisions alone
        if len(rows) > EXCEPTIONS:
            raise ValueError(f"more than {EXCEPTIONS} surrogates collide")
        return {(r["role"], r["normal"]): r["attempt"] for r in rows}

    redo = exceptions(again(parts.where(F.col("role").isin(*PARTS)), key))
    redo |= exceptions(again(parts.where(~F.col("role").isin(*PARTS)), key, names=names, tried=sc.broadcast(dict(redo))))
    release(parts)
    sent = sc.broadcast(redo)

    def rewrite(frames):
        role = _roles(_names(names))
        for f in frames:
            texts = [replaced(t, [(x["s"], x["e"], surrogate(x["k"], t[x["s"] : x["e"]], key, sent.value, role)) for x in a]) for t, a in zip(f["text"], f["at"])]
            yield pd.DataFrame({"doc_id": f["doc_id"], "surrogate_text": texts, "n_values": [len(a) for a in f["at"]]})

    return found.select("doc_id", "text", "at").mapInPandas(rewrite, "doc_id string, surrogate_text string, n_values bigint")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(table(spark, sf_dir, "mainpipe_cleaned_v4"), lexicon(table(spark, sf_dir, "person_lexicon")))


def _kinds(df: DataFrame) -> list:
    """The rows of a table of kinds; a table of more than a thousand is none."""
    rows = df.select("pii_type", "placeholder").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1000 kinds of personal data")
    return rows


def p2_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the placeholders of ``pii_kinds`` in place of its values, and the number of values."""
    rows = lexicon(table(spark, sf_dir, "person_lexicon"))
    mark = {r[0]: r[1] for r in _kinds(table(spark, sf_dir, "pii_kinds"))}
    ship(spark)

    def run(frames):
        names = _names(rows)
        for f in frames:
            got = [find(t, names) for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "masked_text": [replaced(t, [(s, e, mark.get(k, f"<{k.upper()}>")) for s, e, k in g]) for t, g in zip(f["text"], got)], "n_values": [len(g) for g in got]})

    v4 = table(spark, sf_dir, "mainpipe_cleaned_v4").select("doc_id", F.col("text_deep_clean").alias("text"))
    return v4.mapInPandas(run, "doc_id string, masked_text string, n_values bigint")


def p2_surrogates(spark: SparkSession, sf_dir: str, key: bytes | None = None) -> DataFrame:
    """Every page with keyed surrogates in place of its values. The key is the setting ``spark.corpusloom.surrogateKey``,
    or made up for this run, so that nobody can repeat it."""
    key = key or spark.conf.get("spark.corpusloom.surrogateKey", "").encode() or secrets.token_bytes(32)
    return surrogates(table(spark, sf_dir, "mainpipe_cleaned_v4"), lexicon(table(spark, sf_dir, "person_lexicon")), key)
