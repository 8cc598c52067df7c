"""Personal data replaced by keyed surrogates (operator 9).

Detected: e-mail addresses, telephone numbers (with a country code, in the US shape, or national
ones that begin with 0), IPv4 and IPv6 addresses, compressed ones too, account and card numbers
(13 to 19 digits), US social security numbers, IBANs, access keys and values of secrets, and
names of persons: all capitalised words after a title or a known first name, and wherever else
the same document has a family name found so. The README lists what is not detected.

A surrogate is a keyed permutation of the values that look like the original, so that different
originals cannot share one:

- letters become letters of the same script, case and kind (vowel or not), digits digits, and
  everything else stays, which keeps formats;
- card numbers and IBANs keep valid check digits, IP addresses stay IP addresses, telephone
  numbers keep their country code or leading 0, e-mail addresses their top-level domain;
- access keys keep the prefix that tells their kind, hexadecimal secrets stay hexadecimal;
- first names come from the list of the same gender and script. Names are mapped part by part,
  so that ``Ms. Weber`` and ``Anna Weber`` stay one family, whatever the document.

The mapping is global: distinct values of all documents are collected in a table. A surrogate
that is itself an original of the corpus, or that two originals have, of whatever kinds, is made again under the
next tweak of the key until no collision is left. After ``WIDEN_AFTER`` rounds, where most values
of a shape are originals, surrogates get longer within their kind: names by letters of their own
script and case, numbers by digits, e-mail addresses before the ``@``; numbers with a check digit, IP
addresses and hexadecimal secrets never do. First names and initials come from closed lists, in
which every one may be an original: they stay distinct, and none stands for itself. Texts are then
rewritten by a join with that table.

Null texts stay null; rows without doc_id are treated like others. ``key`` is a secret: who has
it can undo the mapping.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prepare_workers, stored, with_text_key

WIDEN_AFTER = 8
#: Lists of up to so many values are permuted by one cycle, longer ones by a cipher.
SHORT_LIST = 256

# The kinds whose surrogates have a fixed length or come from a list.
CLOSED = ["account", "iban", "ipv4", "ipv6", "first name", "initial", "ssn"]

# Kinds whose originals and surrogates are from one list.
LISTED = ["first name", "initial"]

# Alphabets whose letters may stand for each other.
ALPHABETS = [
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "AEIOU",
    "BCDFGHJKLMNPQRSTVWXYZ",
    "áàâäãåéèêëíìîïóòôöõúùûü",
    "ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜ",
    "аеиоуыэюя",
    "бвгджзйклмнпрстфхцчшщ",
    "АЕИОУЫЭЮЯ",
    "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
    "ΑΕΗΙΟΥΩ",
    "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
]

# First names by script and gender.
FIRST_NAMES = {
    "latin female": """Mary Anna Maria Laura Julia Emma Sophie Marie Claire Camille Carmen Lucia Elena Isabel Ingrid Helga
        Sabine Petra Karen Susan Linda Nancy Alice Sarah Emily Olivia""".split(),
    "latin male": """John James Robert Michael David Thomas Peter Paul Pierre Jean Louis Hans Klaus Jürgen Stefan Karl José
        Juan Carlos Miguel Pedro George Edward Henry William Daniel""".split(),
    "cyrillic female": "Анна Мария Елена Ольга Наталья Ирина Светлана Татьяна".split(),
    "cyrillic male": "Иван Сергей Алексей Дмитрий Николай Андрей Михаил Владимир".split(),
}
GENDER_OF = {name: group for group, names in FIRST_NAMES.items() for name in names}

_WORD = r"[^\W\d_]"
_UPPER = "[A-ZÀ-ÖØ-ÞА-ЯΑ-Ω]"
_CAPITAL = rf"(?={_UPPER})" + _WORD + r"[\w'’-]*"
# Capitalised words; a point may follow an initial.
_MORE = rf"(?:(?:(?<=\W{_UPPER})\.)? {_CAPITAL})"
_KNOWN = "|".join(sorted(GENDER_OF, key=lambda name: (-len(name), name)))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_GROUP = "[0-9a-fA-F]{1,4}"
_SECRET_WORDS = ("password", "passwd", "pwd", "secret", "token", "key")
_KEY_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "eyJ")
_TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Mme", "Sr", "Sra")
_GROUPED = re.compile(r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}")
#: Kind, pattern, and what a text must have one of; "0" stands for two digits in a row. Tried in
#: this order; a match takes its characters from the patterns after it.
PATTERNS = [
    ("email", re.compile(r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}(?![\w-])"), ("@",)),
    ("secret", re.compile(r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key))\s*[=:]\s*[\"']?([^\s\"'<>,;]{6,})"), _SECRET_WORDS),
    ("secret", re.compile(r"(?<!\w)((?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_\w{20,}|sk-[\w-]{20,}|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]+)(?![\w-])"), _KEY_STARTS),
    ("iban", re.compile(r"(?<!\w)([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)"), ("0",)),
    ("ipv6", re.compile(rf"(?<![\w:])((?:{_GROUP}:){{6}}(?:{_GROUP}:{_GROUP}|{_OCTET}(?:\.{_OCTET}){{3}}))(?!\w|:[\w:]|\.\d)"), (":",)),
    ("ipv6", re.compile(rf"(?<![\w:])((?:{_GROUP}(?::{_GROUP}){{0,6}})?::(?:(?:{_GROUP}:){{0,5}}{_OCTET}(?:\.{_OCTET}){{3}}|{_GROUP}(?::{_GROUP}){{0,6}})?)(?!\w|:[\w:]|\.\d)"), ("::",)),
    ("ipv4", re.compile(rf"(?<![\w.])({_OCTET}(?:\.{_OCTET}){{3}})(?![\w]|\.\d)"), ("0",)),
    ("account", re.compile(r"(?<![\w.+-])(\d(?:[ -]?\d){12,18})(?![\w-]|\.\d)"), ("0",)),
    ("ssn", re.compile(r"(?<![\w-])(\d{3}-\d{2}-\d{4})(?![\w-])"), ("0",)),
    ("phone", re.compile(rf"(?<![\w+])({_GROUPED.pattern})(?!\w)"), ("+",)),
    ("phone", re.compile(r"(?<![\w+])(\+\d{1,3}(?:[ ./-]?\(?\d{1,4}\)?){2,7})(?!\w)"), ("+",)),
    ("phone", re.compile(r"(?<![\w+-])((?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4})(?![\w-])"), ("0",)),
    ("phone", re.compile(r"(?<![\w+.,/-])(\(0\d{1,4}\) ?\d{2,8}(?:[ ./-]\d{2,8}){0,4}|0\d{1,4}(?:(?: ?[./-] ?| )\d{2,8}){1,5}|0[1-9]\d{8,10})(?![\w-]|[.,/]\d)"), ("0",)),
    # Without a look behind, which would make these patterns try every place of a text.
    ("name", re.compile(rf"(?:(?:{'|'.join(_TITLES)})\.? )+({_CAPITAL}{_MORE}*)"), _TITLES),
    ("name", re.compile(rf"((?:{_KNOWN}){_MORE}+)"), ()),
]
_TWO_DIGITS = re.compile(r"\d{2}")
_PART = re.compile(r"\S+")
_INITIAL = re.compile(rf"{_UPPER}\.?")
_POSSESSIVE = re.compile(r"['’]s?$")
_MENTION = re.compile(rf"(?<!\w){_CAPITAL}")
_LETTERS = re.compile(r"\w+")
_DATE = re.compile(r"\d\d\D\d\d\D\d{4}")
# Words that a run of capitalised words may take in from a sentence or heading.
_COMMON = set("""The An And Or But In On At Of To For From With By As If So He She It They We You His Her Its Their This That Then
    There When Where Who What How Is Was Are Were Has Had Not No Der Die Das Den Dem Des Ein Eine Und Oder Aber Im Am Zu Von Mit Er Sie
    Es Wir Ihr Ist War Hat Le La Les Un Une Et Ou Mais Dans De Du Au Il Elle Nous Vous El Los Las Una Pero En Del Al Con Por""".split())
_NATIONAL = re.compile(r"\(?0|1[ .-]|")
_KEY_PREFIX = re.compile(r"AKIA|ASIA|gh[pousr]_|sk-|eyJ|")
_HEXADECIMAL = re.compile(r"[0-9a-f]+|[0-9A-F]+")


def _valid(kind: str, value: str) -> bool:
    if kind == "ipv6":
        return _is_ipv6(value)
    if kind == "phone" and value[0] in "+0(":
        # The second pattern for country codes asks for more digits than the first, which is strict in groups.
        return bool(_GROUPED.fullmatch(value)) or 8 <= sum(map(str.isdigit, value)) <= 15 and not _DATE.fullmatch(value)
    return kind != "iban" or _iban_rest(value) == 1


def _is_ipv6(value: str) -> bool:
    """Whether it is an address; short forms such as ``1::2`` in ranges that nobody has been given are not taken for one."""
    try:
        address = ipaddress.IPv6Address(value)
    except ValueError:
        return False
    return "::" not in value or "." in value or not (address.is_reserved or address.is_loopback or address.is_unspecified)


def _iban_rest(value: str) -> int:
    plain = value.replace(" ", "")
    return int("".join(str(int(sign, 36)) for sign in plain[4:] + plain[:4])) % 97


def entities(text: str) -> list[tuple[int, int, str]]:
    """Begin, end and kind of all personal data, in order and without overlaps."""
    taken: list[tuple[int, int, str]] = []
    lower = text.lower()
    digits = _TWO_DIGITS.search(text) is not None
    for kind, pattern, needed in PATTERNS:
        if needed == ("0",):
            if not digits:
                continue
        elif needed and not any(sign in (lower if needed is _SECRET_WORDS else text) for sign in needed):
            continue
        for found in pattern.finditer(text):
            begin, end = found.span(pattern.groups)
            before = text[found.start() - 1 : found.start()]
            if kind == "name" and (before.isalnum() or before == "_"):
                continue
            if not _valid(kind, text[begin:end]) or any(begin < b and a < end for a, b, _ in taken):
                continue
            if kind != "name":
                taken.append((begin, end, kind))
            for part in _PART.finditer(text, begin, end) if kind == "name" else ():
                taken.append(_name(*part.span(), text))
    return _with_mentions(text, sorted(taken))


def _without_possessive(begin: int, end: int, text: str) -> int:
    """The end of the word without its possessive."""
    found = _POSSESSIVE.search(text[begin:end])
    return begin + found.start() if found and found.start() else end


def _name(begin: int, end: int, text: str) -> tuple[int, int, str]:
    if _INITIAL.fullmatch(text, begin, end):
        return begin, end, "initial"
    end = _without_possessive(begin, end, text)
    return begin, end, "first name" if text[begin:end] in GENDER_OF else "family name"


def _with_mentions(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Also the other places of the family names among ``taken``, which is sorted."""
    names = {text[a:b] for a, b, kind in taken if kind == "family name"} - _COMMON
    if not names:
        return taken
    begins = [a for a, _, _ in taken]
    more = []
    for word in _MENTION.finditer(text):
        begin, end = word.start(), _without_possessive(*word.span(), text)
        spans = [(begin, end)] if text[begin:end] in names else [p.span() for p in _LETTERS.finditer(text, begin, end) if p[0] in names]
        for a, b in spans:
            before = bisect_left(begins, b) - 1
            if before < 0 or taken[before][1] <= a:
                more.append((a, b, "family name"))
    return sorted(taken + more)


def _number(key: bytes, *parts) -> int:
    message = "\x1f".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(message, key=key, digest_size=32).digest(), "big")


def permuted(value: int, size: int, key: bytes, label: str) -> int:
    """A keyed permutation of ``range(size)``: a Feistel network, walked until it lands inside."""
    if size < 2:
        return value
    one = 1
    while one * one < size:
        one *= 2
    while True:
        left, right = divmod(value, one)
        for turn in range(8):
            left, right = right, (left + _number(key, label, size, turn, right)) % one
        value = left * one + right
        if value < size:
            return value


_PLACE = {sign: (alphabet, at) for alphabet in ALPHABETS for at, sign in enumerate(alphabet)}


@lru_cache(maxsize=4096)
def _cycle(size: int, key: bytes, label: str) -> dict[int, int]:
    """A permutation of a short list that leaves nothing in its place: one keyed cycle of all."""
    order = sorted(range(size), key=lambda value: permuted(value, size, key, label))
    return dict(zip(order, order[1:] + order[:1], strict=True))


def same_shape(text: str, key: bytes, label: str) -> str:
    """Another text of the same shape; different texts of a shape get different ones."""
    spots = [(at, *_PLACE[sign]) for at, sign in enumerate(text) if sign in _PLACE]
    value, size = 0, 1
    for _, alphabet, place in spots:
        value, size = value * len(alphabet) + place, size * len(alphabet)
    # Shapes are kept apart, so that one shape's permutation tells nothing about another's.
    shape = "".join(_PLACE[sign][0][0] if sign in _PLACE else sign for sign in text)
    label = f"{label}\x1f{shape}"
    value = _cycle(size, key, label)[value] if size <= SHORT_LIST else permuted(value, size, key, label)
    out = list(text)
    for at, alphabet, _ in reversed(spots):
        value, place = divmod(value, len(alphabet))
        out[at] = alphabet[place]
    return "".join(out)


def _luhn(digits: str) -> str:
    """The check digit for these digits."""
    total = sum(sum(divmod(2 * int(d), 10)) if at % 2 == 0 else int(d) for at, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _into(form: str, signs: str) -> str:
    """Letters and digits laid into the places of those of ``form``."""
    left = iter(signs)
    return "".join(next(left) if sign.isalnum() else sign for sign in form)


def surrogate(kind: str, value: str, key: bytes, tweak: int) -> str:
    """The replacement of a value under a tweak of the key."""
    key = hashlib.blake2b(tweak.to_bytes(4, "big"), key=key, digest_size=32).digest()
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        other = ".".join([same_shape(label, key, "domain") for label in labels[:-1]] + labels[-1:])
        new = same_shape(local, key, "mailbox") + "@" + other
    elif kind == "account":
        plain = "".join(filter(str.isdigit, value))
        body = same_shape(plain[:-1], key, f"account{len(plain)}")
        # A valid number stays valid, another one invalid by the same difference.
        off = (int(plain[-1]) - int(_luhn(plain[:-1]))) % 10
        new = _into(value, body + str((int(_luhn(body)) + off) % 10))
    elif kind == "iban":
        plain = value.replace(" ", "")
        body = same_shape(plain[4:], key, plain[:2])
        check = 98 - _iban_rest(plain[:2] + "00" + body)
        new = _into(value, f"{plain[:2]}{check:02d}{body}")
    elif kind == "ipv4":
        number = int.from_bytes(bytes(map(int, value.split("."))), "big")
        new = ".".join(map(str, permuted(number, 1 << 32, key, kind).to_bytes(4, "big")))
    elif kind == "ipv6":
        number = permuted(int(ipaddress.IPv6Address(value)), 1 << 128, key, kind)
        new = ":".join(f"{number:032x}"[at : at + 4] for at in range(0, 32, 4))
    elif kind == "phone" and value.startswith("+"):
        country = re.match(r"\+\d{1,3}(?=\D)|\+\d", value)[0]
        new = country + same_shape(value[len(country) :], key, kind)
    elif kind == "phone":
        country = _NATIONAL.match(value)[0]
        new = country + same_shape(value[len(country) :], key, kind)
    elif kind == "first name":
        names = FIRST_NAMES[GENDER_OF[value]]
        new = names[_cycle(len(names), key, GENDER_OF[value])[names.index(value)]]
    elif kind == "secret" and _HEXADECIMAL.fullmatch(value):
        number = permuted(int(value, 16), 16 ** len(value), key, f"hexadecimal{len(value)}")
        new = f"{number:0{len(value)}x}"
        new = new.upper() if value.isupper() else new
    elif kind == "secret":
        prefix = _KEY_PREFIX.match(value)[0]
        new = prefix + same_shape(value[len(prefix) :], key, kind + prefix)
    else:
        new = same_shape(value, key, kind)
    return widened(kind, value, new, key) if tweak > WIDEN_AFTER else new


def widened(kind: str, value: str, new: str, key: bytes) -> str:
    """A surrogate made longer without losing its format; of kinds of a fixed length, itself."""
    if kind in CLOSED or kind == "secret" and _HEXADECIMAL.fullmatch(value):
        return new
    letters = "".join(filter(str.isalpha, value.rpartition("@")[0] if kind == "email" else value)).lower()
    seed = (letters or "0") * 8 if kind in ("email", "family name", "name") else "0" * 8
    more = same_shape(seed[:8], key, f"{kind}\x1f{value}")
    if kind == "email":
        local, _, domain = new.rpartition("@")
        return f"{local}{more}@{domain}"
    return new + (more.upper() if kind != "email" and len(new) > 1 and new.isupper() else more)


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string()), ("value", pa.string())]))
    for batch in batches:
        found = [
            [{"start": a, "stop": b, "kind": name, "value": text[a:b]} for a, b, name in entities(text)] if text else []
            for text in batch.column("text").to_pylist()
        ]
        some = pa.array([bool(spans) for spans in found])
        columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(found, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "spans"]).filter(some)


def _replace(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(name) for name in ("kind", "value", "tweak")]
        new = [surrogate(kind, value, key, tweak) for kind, value, tweak in zip(*(column.to_pylist() for column in columns), strict=True)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(new, pa.string())], names=["kind", "value", "tweak", "surrogate"])


def mapping(values: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, surrogate`` for distinct ``kind, value``: no surrogate twice, none an original of any kind.

    Of values with the same surrogate one keeps it, a value from a closed list before others.
    """
    schema = "kind string, value string, tweak int, surrogate string"
    table = stored(values.withColumn("tweak", F.lit(0)).mapInArrow(partial(_replace, key=key), schema), "surrogates")
    originals = values.select(F.col("value").alias("known")).distinct()
    from_list = F.col("kind").isin(LISTED)
    claim = F.struct((~from_list).alias("later"), "kind", "value")
    while True:
        taken = table.where(~from_list).join(originals, F.col("surrogate") == F.col("known"), "left_semi").select("kind", "value")
        owners = table.groupBy("surrogate").agg(F.min(claim).alias("owner"), F.max(claim).alias("last")).where("owner <> last")
        shared = table.join(owners, "surrogate").where(claim != F.col("owner")).select("kind", "value")
        clashing = stored(taken.union(shared).distinct(), "surrogate_clashes")
        if clashing.isEmpty():
            return table.select("kind", "value", "surrogate")
        again = table.join(clashing, ["kind", "value"], "left_semi").select("kind", "value", (F.col("tweak") + 1).alias("tweak"))
        kept = table.join(clashing, ["kind", "value"], "left_anti")
        table = stored(kept.unionByName(again.mapInArrow(partial(_replace, key=key), schema)), "surrogates")


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            if spans:
                parts, at = [], 0
                for span in sorted(spans, key=lambda span: span["start"]):
                    parts += [text[at : span["start"]], span["surrogate"]]
                    at = span["stop"]
                text = "".join(parts) + text[at:]
            texts.append(text)
        yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string())).select(["doc_id", "text", "n_entities", "kinds"])


def pseudonymised(documents: DataFrame, key: bytes) -> DataFrame:
    """``doc_id, text, n_entities, kinds`` for every row of ``documents``, the text rewritten."""
    prepare_workers(documents.sparkSession)
    rows = with_text_key(documents)
    found = stored(
        rows.mapInArrow(
            _detect, "doc_id long, text_key long, spans array<struct<start: long, stop: long, kind: string, value: string>>"
        ).dropDuplicates(["doc_id", "text_key"]),
        "entities",
    )
    spans = found.select("doc_id", "text_key", F.inline("spans"))
    table = mapping(spans.select("kind", "value").distinct(), key)
    by_text = (
        spans.join(table, ["kind", "value"])
        .groupBy("doc_id", "text_key")
        .agg(
            F.collect_list(F.struct("start", "stop", "surrogate")).alias("spans"),
            F.array_sort(F.collect_set("kind")).alias("kinds"),
        )
    )
    same = F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.text_key") == F.col("f.text_key"))
    joined = rows.alias("r").join(by_text.hint("merge").alias("f"), same, "left")
    planned = joined.select(
        "r.doc_id",
        "text",
        "spans",
        F.greatest(F.size("spans"), F.lit(0)).cast("long").alias("n_entities"),
        F.concat_ws(",", "kinds").alias("kinds"),
    )
    return planned.mapInArrow(_rewrite, "doc_id long, text string, n_entities long, kinds string")
