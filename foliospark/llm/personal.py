"""Personal data in free text: found by anchors, expanded and validated by local parsers, replaced by placeholders.

An Aho-Corasick automaton finds at-signs (also spelt out), street words, and the cues and schemes of telephone and
identity numbers; a parser per kind reads the text around each anchor and decides where the item begins and ends. Runs of
digits are anchors too: numbers are read whole and told apart by form, by check digits and by the cues around them. Names
are read from given names: the listed ones, and those learned from the collection, where the same capitalised word
stands with many different surnames.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.sources.tables import cut, spread

KINDS = ["email", "phone", "identity_number", "address", "name"]
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "identity_number": "[ID]", "address": "[ADDRESS]", "name": "[NAME]"}
#: A word can be common if it makes up this share of the different words of different texts: at most 50,000 words
#: whatever the collection's size.
COMMON_SHARE = 2e-5
#: Such a word is common if it stands in small letters in this share of its texts, or else if it stands as a surname, with a
#: given name or an initial, in less than NAMED_SHARE of the texts that have it in capitals.
SMALL_SHARE, NAMED_SHARE = 0.1, 0.1
#: A given name is learned if it stands with so many different surnames at least, however large the collection, and if a
#: capitalised word follows it in this share of the texts that have it in capitals, or with a comma stands before it.
LEARNED_PAIRS, LEARNED_SHARE = 3, 0.2

#: Signs of mail addresses, as they are typed or spelt out.
AT = r"(?:\s?[@＠]\s?|\s?[\[({<]\s?(?:at|arroba|arobase|ät|a)\s?[\])}>]\s?|\s(?:at|arroba|arobase|AT|ät)\s)"
DOT = r"(?:\.|\s?[\[({]\s?(?:dot|punkt|point|punto)\s?[\])}]\s?|\s(?:dot|punkt|point|punto|DOT)\s)"
#: Street words, as they stand before or after a street's name.
STREETS_EN = "Street St Road Rd Lane Ln Avenue Ave Close Row Quay Way Drive Dr Court Ct Place Pl Square Sq Terrace Crescent Gardens Grove Hill Walk Mews Yard Gate Boulevard Blvd Parade Rise View Wharf Alley Park Green Bridge".split()
STREETS_FR = "rue impasse avenue quai allée allee place chemin boulevard cours passage ruelle sentier route square faubourg venelle esplanade rond-point montée".split()
STREETS_ES = "Calle C/ Plaza Avenida Avda Av Camino Paseo Ronda Travesía Callejón Cuesta Carretera Plazuela Glorieta Rambla Vía Costanilla Pasaje Alameda".split()
STREETS_IT = "Via Viale Piazza Piazzale Corso Vicolo Largo".split()
STREETS_DE = "straße strasse str. weg gasse platz allee ufer damm ring steig pfad markt hof chaussee graben brücke wall stieg zeile twiete".split()
#: Words that make a capitalised pair a place or an institution.
PLACES = set(
    "lake mount river institute institution archive archives foundation school college university library museum society press hall house hospital church abbey castle bridge park prize award "
    "institut archiv stiftung schule bibliothek see berg fluss kirche schloss verein gesellschaft verlag museum haus hochschule universität akademie "
    "lac mont fondation école lycée bibliothèque musée société église château université académie prix éditions maison collège "
    "lago monte río archivo instituto fundación escuela colegio biblioteca museo sociedad iglesia castillo universidad academia premio editorial casa".split()
) | {w.lower().rstrip(".") for w in STREETS_EN + STREETS_FR + STREETS_ES}
#: Those of them that stand before a name; in German all of them, else also in small letters.
LEADING_SMALL = set("lac lago monte río archivo instituto fundación escuela colegio biblioteca museo institut fondation école lycée bibliothèque musée société prix rue impasse avenue quai place chemin boulevard".split())
LEADING = LEADING_SMALL | set("lake mount river institute archive foundation school university library museum archiv stiftung schule bibliothek museum calle plaza avenida camino paseo street".split())
#: Titles, which aren't part of a name.
TITLES = set("dr mr mrs ms miss mx prof professor sir lady dame rev herr frau fräulein doktor m mme mlle monsieur madame mademoiselle maître señor señora señorita sr sra srta don doña profesor profesora doctor doctora la el tutor contact".split())
#: What stands before the number of a paper, an insured person or a tax payer.
IDENTITY_CUES = (
    r"(?:passport|identity|identification|\bid\b|\bcard\b|tax\b|taxpayer|insurance|social security|licen[cs]e|\bssn\b|\bnino?\b|"
    r"ausweis|personalausweis|reisepass|steuer|versicherung|versicherten|kennnummer|identifikation|"
    r"assuré|sécurité sociale|carte d'identité|passeport|fiscal|fiscale|numéro d'|\bnir\b|"
    r"documento|\bdni\b|\bnie\b|\bnif\b|pasaporte|identidad|seguridad social|contribuyente|afiliad)"
)
#: What stands before numbers that belong to nobody.
OTHER_CUES = r"\b(?:isbn|issn|order|shelf ?mark|mark|qv|signatur|cote|signatura|invoice|bestellung|commande|pedido|batch|rechnung|facture|factura|pages?|seiten?)(?: (?:number|no\.?|nr\.?|nummer|numéro|número|n\.º|n°))?[\s:#-]{0,3}$"

_CAP = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:['’][A-ZÀ-Þa-zß-ÿ]+)?"
_UPP = r"[A-ZÀ-ÖØ-Þ]{3,}"
_SURNAME = rf"(?:(?:{_CAP})(?:-{_CAP})*|(?:{_UPP})(?:-{_UPP})*)"
_SIGN = re.compile(AT)
_HOST = re.compile(rf"(?:[\w-]+{DOT})+[A-Za-z]{{2,}}(?![\w])")
_BEFORE = re.compile(r"(?<![\w.+-])[\w.+-]*[\w+]$")
_LOCAL = re.compile(r"^[A-Za-z0-9][\w.+-]*$")
_NUMBERS = re.compile(r"(?<![\w@.,/+-])(?:\+|\(\+?)?\d[\d()./  -]{5,24}\d(?!\w)")
_EXTENSION = re.compile(r"\s?(?:ext\.?|x|Durchwahl|poste|extensión)\s?\d{1,5}\b")
_IDENTITIES = [
    (re.compile(r"(?<![\w-])[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D](?!\w)"), True),
    (re.compile(r"(?<![\w-])\d{3}([- ])\d{2}\1\d{4}(?![\w-])"), True),
    (re.compile(r"(?<![\w-])[12][  ]?\d{2}[  ]?(?:\d{2})[  ]?(?:\d{2}|2[AB])[  ]?\d{3}[  ]?\d{3}[  ]?\d{2}(?![\w-])"), True),
    (re.compile(r"(?<![\w-])\d{8}-?[A-HJ-NP-TV-Z](?!\w)"), True),
    (re.compile(r"(?<![\w-])[XYZ]-?\d{7}-?[A-Z](?!\w)"), True),
    (re.compile(r"(?<![\w-])[CFGHJKLMNPRTVWXYZ]\d{2,3}[CFGHJKLMNPRTVWXYZ0-9]\d{4,5}[A-Z0-9]?(?!\w)"), False),
    (re.compile(r"(?<![\w-])[A-Z]{1,3}-?\d{6,9}[A-Z]?(?!\w)"), False),
    (re.compile(r"(?<![\w-])\d{2} ?\d{3} ?\d{3} ?\d{3}(?![\w-])"), False),
    (re.compile(r"(?<![\w-])\d(?:[\d  /-]{5,20})\d(?:[ -]?[A-Z])?(?!\w)"), False),
]
_CUE = re.compile(IDENTITY_CUES, re.IGNORECASE)
#: A cue after the number: ``123 as identity number``.
_CUE_AFTER = re.compile(rf"\s?(?:,\s)?(?:as|is|was|als|ist|war|comme|est|como|es|fue)\s[^.!?;\n\d]{{0,25}}?{IDENTITY_CUES}", re.IGNORECASE)
#: Cues as the automaton finds them, in small letters.
IDENTITY_ANCHORS = (
    "passport", "identity", "identification", "tax", "insurance", "social security", "licence", "license", "ssn", "ausweis", "reisepass", "steuer", "versicherung", "assuré", "sécurité sociale", "passeport",
    "fiscal", "documento", "dni", "nie", "nif", "pasaporte", "identidad", "seguridad social", "contribuyente", "afiliad", "codice fiscale", "passaporto",
)
PHONE_ANCHORS = ("tel:", "tel.", "phone", "telefon", "téléphone", "teléfono", "telefono", "mobile", "mobil", "handy", "móvil", "fax", "call ", "ring ", "llam", "appel", "erreich")
#: Numbers of papers that mix letters and digits.
_MIXED = re.compile(r"(?<![\w@./-])(?=(?:[A-Z -]*\d){5})(?=[\d -]*[A-Z])[A-Z0-9](?:[ -]?[A-Z0-9]){6,17}(?![\w@/-])")
_OTHER = re.compile(OTHER_CUES, re.IGNORECASE)
_HOUSE = r"\d{1,4}(?:\s?[a-h]|\s?(?:bis|ter))?(?!\w)"
_FLAT = r"(?:(?:Flat|Apt\.?|Apartment|Unit|Suite|Room)\s\d{1,4}\w?,?\s|(?:Appt\.?|Appartement|Apt\.?)\s\d{1,4}\w?,?\s|(?:Wohnung|Whg\.?)\s\d{1,4}\w?,?\s)?"
_ADDRESSES = [
    re.compile(rf"(?<![\w/.,-]){_FLAT}{_HOUSE},?\s(?:(?:[A-Z][\w'’]+)\s){{1,3}}(?:{'|'.join(sorted(STREETS_EN, key=len, reverse=True))})(?!\w)"),
    re.compile(rf"(?<![\w/.-]){_FLAT}{_HOUSE},?\s(?:{'|'.join(STREETS_FR)})\s(?:(?:de|du|des|la|le|les|aux?|à|sur)\s|[dl]['’])*[A-ZÀ-Þ][\w'’-]*(?:\s(?:(?:de|du|des|la|le|les)\s|[dl]['’])*[A-ZÀ-Þ][\w'’-]*)*", re.IGNORECASE),
    re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, STREETS_ES))})\.?\s(?:(?:de|del|la|las|los|el)\s)*[A-ZÀ-Þ][\w'’-]*(?:\s(?:(?:de|del|la|las|los|y)\s)*[A-ZÀ-Þ][\w'’-]*)*,?\s(?:n\.?\s?[ºo°]\.?\s?|núm\.?\s|número\s|#)?{_HOUSE}"),
    re.compile(rf"(?<!\w)(?:[A-ZÄÖÜ][\wäöüß-]*?(?:{'|'.join(map(re.escape, STREETS_DE))})|(?:[A-ZÄÖÜ][\wäöüß]+(?:er|en|es|e)?\s)(?:Straße|Strasse|Str\.|Weg|Gasse|Platz|Allee|Ufer|Damm|Ring|Markt|Hof))\s{_HOUSE}"),
    re.compile(rf"(?<!\w)(?:Am|An der|An den|An dem|Im|In der|In den|Zum|Zur|Auf dem|Auf der|Unter den|Hinter dem|Hinter der|Vor dem|Beim)\s(?:Alten?|Neuen?|Hohen?|Langen?|Großen?|Kleinen?|Oberen?|Unteren?|Roten?|Weißen?|Schwarzen?|Grünen?)\s[A-ZÄÖÜ][a-zäöüß]+\s{_HOUSE}"),
    re.compile(rf"(?<!\w)(?:{'|'.join(STREETS_IT)})\s(?:(?:del|della|dei|di|da|la|San|Santa)\s)*[A-ZÀ-Þ][\w'’-]*(?:\s[A-ZÀ-Þ][\w'’-]*)*,?\s{_HOUSE}"),
]
#: A German place that tells no street by itself: an address after a cue or before a postcode.
_PLACED_ADDRESS = re.compile(rf"(?<!\w)(?:Am|An der|Im|In der|Zum|Zur|Auf dem|Auf der|Unter den|Beim)\s[A-ZÄÖÜ][a-zäöüß]+(?:\s[A-ZÄÖÜ][a-zäöüß]+)?\s{_HOUSE}")
_ADDRESS_CUE = re.compile(r"(?:Anschrift|Adresse|Wohnung|wohn\w*|lebt|lebe|zieh\w*|\w*gezogen)\b[^.!?\n]{0,25}$")
_POSTCODE = re.compile(r",\s\d{5}\s[A-ZÄÖÜ]")
_NAME = re.compile(
    rf"(?<![\w.@＠+'’-])(?:"
    rf"(?P<g1>{_CAP}|{_UPP})\s(?:[A-ZÀ-Þ]\.\s)?(?P<s1>{_SURNAME})|"
    rf"(?P<i2>[A-ZÀ-Þ])\.\s?(?:[A-ZÀ-Þ]\.\s?)?(?P<s2>{_SURNAME}))(?![\w@＠]|[-.+]\w)"
)
_TURNED = re.compile(rf"(?<![\w.@＠+'’-])(?P<s>{_SURNAME}),\s(?:(?P<g>{_CAP}|{_UPP})(?:\s[A-ZÀ-Þ]\.)?|(?P<i>[A-ZÀ-Þ])\.)(?![\w@＠]|[-+]\w)")
_WORD = re.compile(r"[^\W\d_]+")
_CAPITALISED = re.compile(r"(?<![\w.@＠+'’-])[A-ZÀ-ÖØ-Þ][^\W\d_]+")
_INITIAL = re.compile(r"(?<![\w.@＠+'’-])[A-ZÀ-ÖØ-Þ]\.(?=\s?[A-ZÀ-ÖØ-Þ]|[^\w]|$)")
_DIGITS = re.compile(r"\d(?:[ \-./()A-Z]*\d){5,}[ -]?[A-Z0-9]?(?!\w)|[A-Z]\d{2,3}[A-Z]\d{4,}\w*")
_DIGIT = re.compile(r"\d")
_HOUSE_NUMBER = re.compile(r"(?<![\w.])\d{1,4}(?:\s?[a-h]|\s(?:bis|ter))?(?!\w)")
_GERMAN_PLACE = re.compile(r"\b(?:Am|An|Im|In|Zum|Zur|Auf|Unter|Hinter|Vor|Beim)\s(?:d\w+\s)?[A-ZÄÖÜ][^\d.!?]*$")


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    trie = ahocorasick.Automaton()
    for sign in ("@", "＠", " at ", "[at]", "(at)", "{at}", "<at>", "[ at ]", "( at )", " arroba ", " arobase ", "(arroba)", "[arroba]", "(a)", "[a]", "arobase", " ät ", "(ät)"):
        trie.add_word(sign, "email")
    for word in STREETS_EN + STREETS_FR + STREETS_ES + STREETS_IT + STREETS_DE:
        trie.add_word(word.lower(), "address")
    for kind, cues in (("identity_number", IDENTITY_ANCHORS), ("phone", PHONE_ANCHORS)):
        for cue in cues:
            trie.add_word(cue, kind)
    trie.make_automaton()
    return trie


class Names:
    """Given names (in lower case), words that are too common for a surname, and those of the given names that were listed."""

    def __init__(self, given: set[str], common: set[str], listed: set[str] = frozenset()):
        self.given, self.common, self.listed = given, common, listed

    def surname(self, word: str, given: str | None = None) -> bool:
        """Whether the word can be a surname; one of two or three letters can with a listed given name."""
        parts = word.split("-")
        least = 2 if given and given.lower() in self.listed else 3 if len(parts) > 1 else 4
        return all(len(p) >= least for p in parts) and not any(p.lower() in self.common or p.lower() in PLACES or p.lower() in TITLES for p in parts)

    def first(self, word: str) -> bool:
        return word.lower() in self.given

    def find(self, text: str) -> list[tuple[int, int]]:
        """Names around every given name and every initial before a capitalised word."""
        spots = [m.start() for m in _CAPITALISED.finditer(text) if m.group().lower() in self.given]
        spots += [m.start() for m in _INITIAL.finditer(text)]
        found: list[tuple[int, int]] = []
        for at in sorted(spots):
            if found and at < found[-1][1]:
                continue
            item = self._turned(text, at) or self._straight(text, at)
            if item and not self._placed(text, *item) and (not found or item[0] >= found[-1][1]):
                found.append(item)
        return found

    def _straight(self, text: str, at: int) -> tuple[int, int] | None:
        m = _NAME.match(text, at)
        if not m or not self.surname(m["s1"] or m["s2"], m["g1"]):
            return None
        if m["g1"] and (not self.first(m["g1"]) or m["g1"].isupper() != m["s1"].isupper()):
            return None
        return m.span()

    def _turned(self, text: str, at: int) -> tuple[int, int] | None:
        """``Surname, Given``, read backwards from the given name or initial."""
        if text[at - 2 : at - 1] != "," or not text[at - 1].isspace():
            return None
        begin = at - 2
        while begin > 0 and (text[begin - 1].isalpha() or text[begin - 1] in "-'’"):
            begin -= 1
        m = _TURNED.match(text, begin)
        if not m or m.end() <= at or not self.surname(m["s"], m["g"]) or self.first(m["s"]) or (m["g"] and (not self.first(m["g"]) or self._goes_on(text, at))):
            return None
        return m.span()

    def _goes_on(self, text: str, at: int) -> bool:
        """Whether the given name after a comma has its surname after it, so that the word before isn't one."""
        m = _NAME.match(text, at)
        return bool(m and m["s1"] and self.surname(m["s1"], m["g1"]) and not self.first(m["s1"]))

    @staticmethod
    def _placed(text: str, start: int, end: int) -> bool:
        """Whether a place or institution is named after the person."""
        after = _WORD.search(text, end, min(len(text), end + 20))
        if after and text[end : after.start()] in (" ", "-", "-", "’s ", "'s ") and after.group()[:1].isupper() and after.group().lower() in PLACES:
            return True
        before = re.search(r"([^\W\d_]+)(?:\s(?:of|de|del|du|des|la))?[\s-]+$", text[max(0, start - 30) : start])
        return bool(before and before.group(1).lower() in LEADING and (before.group(1)[:1].isupper() or before.group(1).lower() in LEADING_SMALL))


def _emails(text: str, at: int) -> tuple[int, int] | None:
    """The mail address around an at-sign: its local part is read backwards, its host forwards."""
    for sign in _SIGN.finditer(text, max(0, at - 8), min(len(text), at + 9)):
        if not sign.start() <= at < sign.end():
            continue
        begin = max(0, sign.start() - 64)
        local, host = _BEFORE.search(text[begin : sign.start()]), _HOST.match(text, sign.end())
        if not local or not host or not _LOCAL.match(local.group()):
            continue
        bare = sign.group().strip()
        if bare[0].isalpha() and not re.search(r"[\[({]|\s(?:dot|punkt|point|punto|DOT)\s", host.group()):
            continue  # the word at, in a sentence
        return begin + local.start(), host.end()
    return None


def _phone(text: str, start: int, end: int) -> bool:
    run = text[start:end]
    digits = re.sub(r"\D", "", run)
    before = text[max(0, start - 34) : start]
    if not 7 <= len(digits) <= 15 or _OTHER.search(before) or re.search(r"\d{1,2}[./]\d{1,2}[./]\d{4}$", run) or (_CUE.search(before[-34:]) and not run.startswith(("+", "("))):
        return False
    groups = re.findall(r"\d+", run)
    if run.startswith(("+", "(+")):
        return len(digits) >= 9
    if run.startswith("00") and not run.startswith("000"):
        return len(digits) >= 11
    if run.startswith("(0") or run.startswith("("):
        return len(digits) >= 9 and ")" in run
    sizes = [len(g) for g in groups]
    if sizes in ([3, 3, 4], [1, 3, 3, 4]) and (sizes[0] != 1 or groups[0] == "1"):
        return True
    if digits[0] == "0" and digits[1] != "0":
        return 9 <= len(digits) <= 12 and not (len(groups) == 1 and len(digits) == 11 and _CUE.search(before))
    if digits[0] in "6789" and len(digits) == 9:
        return len(groups) in (1, 3, 4) and sizes in ([9], [3, 3, 3], [3, 2, 2, 2])
    return False


def _trim(text: str, start: int, end: int) -> tuple[int, int]:
    """Without brackets that belong to the sentence."""
    run = text[start:end]
    while run and run.count("(") > run.count(")"):
        if run[0] == "(":
            start, run = start + 1, run[1:]
        else:
            cut = run.rindex("(")
            run = run[:cut].rstrip()
            end = start + len(run)
    while run and run.count(")") > run.count("("):
        cut = run.rindex(")")
        run = run[:cut].rstrip()
        end = start + len(run)
    return start, end


def find_items(text: str | None, names: Names) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of all items in order; items don't overlap. Null and empty texts have none."""
    if not text:
        return []
    taken: list[tuple[int, int]] = []
    out: list[tuple[str, int, int]] = []

    def take(kind: str, start: int, end: int) -> None:
        k = bisect.bisect(taken, (start, end))
        if (k == 0 or taken[k - 1][1] <= start) and (k == len(taken) or taken[k][0] >= end):
            taken.insert(k, (start, end))
            out.append((kind, start, end))

    lowered = text.lower()
    streets, papers, phones = [], [], []
    for end, kind in _anchors().iter(lowered if len(lowered) == len(text) else text):
        if kind == "email":
            item = _emails(text, end if text[end] in "@＠" else end - 1)
            if item:
                take("email", *item)
        else:
            (streets if kind == "address" else papers if kind == "identity_number" else phones).append(end)
    for start, end in _addresses(text, streets):
        take("address", start, end)
    runs = _stretches(text)
    for a, b in runs:
        for start, end in _identities(text, a, b):
            take("identity_number", start, end)
    for start, end in _papers(text, papers):
        take("identity_number", start, end)
    for m in (m for a, b in runs for m in _NUMBERS.finditer(text, a, b)):
        start = m.start()
        opened = m.group().find(" (")
        if opened > 0 and m.group()[0] != "+":  # a number in brackets after another number
            start += opened + 1
        start, end = _trim(text, start, m.end())
        if _phone(text, start, end) or _called(text, start, end, phones):
            more = _EXTENSION.match(text, end)
            take("phone", start, more.end() if more else end)
    for start, end in names.find(text):
        take("name", start, end)
    return sorted(out, key=lambda x: x[1])


def _stretches(text: str) -> list[tuple[int, int]]:
    """Stretches that hold six digits or more without words between, with what stands right around them."""
    out: list[tuple[int, int]] = []
    for m in _DIGITS.finditer(text):
        a, b = max(0, m.start() - 6), min(len(text), m.end() + 6)
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], b
        else:
            out.append((a, b))
    return out


def _identities(text: str, a: int, b: int) -> Iterator[tuple[int, int]]:
    for pattern, distinct in _IDENTITIES:
        for m in pattern.finditer(text, a, b):
            before = text[max(0, m.start() - 45) : m.start()]
            if sum(c.isdigit() for c in m.group()) < 6 or _OTHER.search(before[-34:]):
                continue
            cue = None
            for cue in _CUE.finditer(before):
                pass
            near = cue and not re.search(r"[.!?;]\s", before[cue.end() :]) and not re.search(r"\d{5}", before[cue.end() :])
            after = _CUE_AFTER.match(text, m.end())
            if near or after or (distinct and text[max(0, m.start() - 1) : m.start()] not in ("+", "/", ".") and not _telephone_cue(before)):
                yield m.span()


def _papers(text: str, cues: list[int]) -> list[tuple[int, int]]:
    """Numbers of letters and digits after a cue, in its sentence and with no other number between, or before it."""
    out: list[tuple[int, int]] = []
    for end in cues:
        if not _DIGIT.search(text, end + 1, min(len(text), end + 40)):
            continue
        for m in _MIXED.finditer(text, end + 1, min(len(text), end + 60)):
            between = re.sub(r"\b(?:no|nr|num|núm|n)\.", "", text[end + 1 : m.start()], flags=re.IGNORECASE)
            if len(between) <= 32 and not re.search(r"[.!?;]\s|\d{3}", between) and not _OTHER.search(text[max(0, m.start() - 34) : m.start()]):
                out.append(m.span())
            break
    return out


def _called(text: str, start: int, end: int, cues: list[int]) -> bool:
    """Whether a number of seven digits or more follows a telephone cue at once, whatever its form."""
    k = bisect.bisect(cues, start) - 1
    if k < 0 or start - cues[k] > 14:
        return False
    digits = sum(c.isdigit() for c in text[start:end])
    between = text[cues[k] + 1 : start]
    return 7 <= digits <= 15 and bool(re.fullmatch(r"\w{0,6}[\s.:]*(?:(?:no|nr|number|nummer|me on|us on|at|unter|au|al|número|numéro)\b[\s.:]*)?", between, re.IGNORECASE)) and not re.search(r"\d{1,2}[./]\d{1,2}[./]\d{4}", text[start:end])


def _addresses(text: str, streets: list[int]) -> list[tuple[int, int]]:
    """Addresses around house numbers that have a street word, or a German place, in reach."""
    out: list[tuple[int, int]] = []
    k = 0
    for house in _HOUSE_NUMBER.finditer(text):
        while k < len(streets) and streets[k] < house.start() - 60:
            k += 1
        near = k < len(streets) and streets[k] < house.end() + 60
        if not near and not _GERMAN_PLACE.search(text, max(0, house.start() - 40), house.start()):
            continue
        a, b = max(0, house.start() - 70), min(len(text), house.end() + 70)
        while a > 0 and text[a - 1].isalnum():
            a -= 1
        while b < len(text) and text[b].isalnum():
            b += 1
        for pattern in _ADDRESSES:
            out += [m.span() for m in pattern.finditer(text, a, b) if m.start() < house.end() and m.end() >= house.end() and m.span() not in out[-6:]]
        for m in _PLACED_ADDRESS.finditer(text, a, b):
            if m.start() < house.end() <= m.end() and (_ADDRESS_CUE.search(text[max(0, m.start() - 40) : m.start()]) or _POSTCODE.match(text, m.end())):
                out.append(m.span())
    return out


def _telephone_cue(before: str) -> bool:
    return bool(re.search(r"(?:tel|phone|ring|call|llam|appel|joindre|erreich|unter|fax|mobil)\w*\.?:?\s*(?:\w+\s)?$", before[-24:], re.IGNORECASE))


def redact(text: str | None, items: list[tuple[str, int, int]]) -> str | None:
    """The text with a typed placeholder for each item; all else stays."""
    if not text or not items:
        return text
    out, at = [], 0
    for kind, start, end in items:
        out += [text[at:start], PLACEHOLDER[kind]]
        at = end
    return "".join([*out, text[at:]])


_PAIR = re.compile(rf"(?<![\w.@'’-])({_CAP})\s(?:[A-ZÀ-Þ]\.\s)?((?:{_CAP})(?:-{_CAP})*)(?![\w@])")
_PAIR_TURNED = re.compile(rf"(?<![\w.@'’-])((?:{_CAP})(?:-{_CAP})*),\s({_CAP})(?![\w@])")


_INITIAL_PAIR = re.compile(rf"(?<![\w.@＠+'’-])[A-ZÀ-ÖØ-Þ]\.\s?(?:[A-ZÀ-Þ]\.\s?)?({_CAP})(?![\w@＠]|-\w)|(?<![\w.@＠+'’-])({_CAP}),\s[A-ZÀ-ÖØ-Þ]\.(?!\s?[A-ZÀ-ÖØ-Þ])")
_GOES_ON = re.compile(rf"\s(?:[A-ZÀ-Þ]\.\s)?{_CAP}")
_LETTERS = re.compile(r"(?<![^\W_])(?<![@＠.+_-])[^\W\d_]{2,}(?![\w@＠+]|[.-][^\W\d_])")
_STATISTICS = "word string, surname string, turned int, n long, small long, capitals long"


def _statistics(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Numbers of texts, added up by batch: of words (in all, in small letters, in capitals), of capitalised pairs as
    (given, surname, whether turned: 1, or 2 if another capitalised word follows), and of surnames with an initial (given
    is null)."""
    for pdf in batches:
        texts, small, capitals, pairs = Counter(), Counter(), Counter(), Counter()
        for text in pdf["text"]:
            forms = set(_LETTERS.findall(text))
            low = {w for w in forms if w == w.lower()}
            high = {w.lower() for w in forms - low}
            texts.update(low | high)
            small.update(low)
            capitals.update(high)
            found = {(m.group(1).lower(), m.group(2).lower(), 0) for m in _PAIR.finditer(text)}
            found.update((m.group(2).lower(), m.group(1).lower(), 2 if _GOES_ON.match(text, m.end()) else 1) for m in _PAIR_TURNED.finditer(text))
            found.update((None, (m.group(1) or m.group(2)).lower(), None) for m in _INITIAL_PAIR.finditer(text))
            pairs.update(found)
        rows = [(w, None, None, n, small[w], capitals[w]) for w, n in texts.items()] + [(*k, n, 0, 0) for k, n in pairs.items()]
        yield pd.DataFrame(rows, columns=["word", "surname", "turned", "n", "small", "capitals"]).astype({"turned": "Int32"})


def learned_names(docs: DataFrame, given_names: DataFrame) -> Names:
    """Statistics over all different texts: common words, and given names learned from pairs of capitalised words.

    A word is a given name if it stands before LEARNED_PAIRS different surnames at least and also after a surname and a
    comma, and if its texts with such pairs are LEARNED_SHARE of those with it in capitals and over five times those
    with it in small letters. No bound grows with the collection. A word is common
    by COMMON_SHARE, SMALL_SHARE and NAMED_SHARE; copies of a text count once.
    """
    texts = spread(docs.select("text").where("text is not null")).distinct()
    stats = cut(texts.mapInPandas(_statistics, _STATISTICS).groupBy("word", "surname", "turned").agg(*(F.sum(c).alias(c) for c in ("n", "small", "capitals"))))
    counts = stats.where("surname is null").select("word", "n", "small", "capitals")
    pairs = stats.where("surname is not null").select(F.col("word").alias("given"), "surname", "turned", "n")
    total = counts.agg(F.sum("n")).first()[0] or 0
    listed = {r[0].strip().lower() for r in given_names.select("given_name").where("given_name is not null").distinct().toLocalIterator()}
    floor = max(8.0, COMMON_SHARE * total)
    many = pairs.where("given is not null").groupBy("given").agg(F.count_if(F.col("turned") == 0).alias("before"), F.count_if(F.col("turned") > 0).alias("turned"), F.sum("n").alias("used"))
    enough = many.where((F.col("before") >= LEARNED_PAIRS) & (F.col("turned") >= 1))
    uses = counts.select(F.col("word").alias("given"), "small", "capitals")
    other = F.coalesce("small", F.lit(0)) * 5 < F.col("used")
    learned = {r["given"] for r in enough.join(uses, "given", "left").where(other & (F.col("used") >= LEARNED_SHARE * F.coalesce("capitals", F.lit(0)))).select("given").toLocalIterator()}
    given = (listed | learned) - PLACES - TITLES - {""}
    frequent = counts.where(F.col("n") >= floor)
    common = {r["word"] for r in frequent.where(F.col("small") >= SMALL_SHARE * F.col("n")).select("word").toLocalIterator()}
    known = docs.sparkSession.createDataFrame([(g,) for g in sorted(given)], "given string")
    named = pairs.where("given is null").unionByName(pairs.where("turned < 2").join(known, "given", "left_semi")).groupBy(F.col("surname").alias("word")).agg(F.sum("n").alias("named"))
    rest = frequent.where(F.col("small") < SMALL_SHARE * F.col("n")).join(named, "word", "left").where(F.coalesce("named", F.lit(0)) < NAMED_SHARE * F.col("capitals"))
    common.update(r["word"] for r in rest.select("word").toLocalIterator())
    return Names(given, common - given, listed & given)


def personal_items(docs: DataFrame, given_names: DataFrame) -> DataFrame:
    """``(doc_id, kind, start_char, end_char)`` of every item; places are 0-based code points. Repeated rows count once."""
    names = learned_names(docs, given_names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(d, k, a, b) for d, t in zip(pdf["doc_id"], pdf["text"]) for k, a, b in find_items(t, names)], columns=["doc_id", "kind", "start_char", "end_char"])

    return spread(docs.select("doc_id", "text").where("doc_id is not null")).mapInPandas(run, "doc_id long, kind string, start_char long, end_char long").distinct()


def redacted(docs: DataFrame, given_names: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with placeholders; null and empty texts stay as they are."""
    names = learned_names(docs, given_names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": [redact(t, find_items(t, names)) for t in pdf["text"]]})

    return spread(docs.select("doc_id", "text")).mapInPandas(run, "doc_id long, text string")
