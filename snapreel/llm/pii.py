"""Surrogates for personal data: keyed, consistent, and of the same type and format.

Detected entities are emails, phone numbers, payment cards, social security
numbers, IBANs, IPv4 addresses, secrets (assigned tokens, long hexadecimal
strings) and names of people (after a title, or from given names of known
gender in Latin and Cyrillic script, with the surname that follows and its later
uses in the document). An entity is known by a canonical form -- a phone
number's digits, an address in lower case -- so different spellings of one
entity stay one entity.

A surrogate is made by a keyed permutation of the canonical form's symbols,
each within its own alphabet (digits, letters of a case and script, vowels and
consonants of names, a ring of given names of one gender and script). Permutations give
different surrogates to different originals and the same one to all mentions.
What they cannot know is checked over the whole corpus: a surrogate that is
itself an original, or that two originals of a type share, is made again with
the next tweak, until neither occurs. The values of a short format (a surname
of two letters) may all be originals, so from tweak ``WIDEN`` on names, emails
and secrets get letters more; formats of digits, of 10**8 values or more, may
from tweak ``FULL`` on take another's original, but never their own. Mentions
are then rewritten in their own separators and case. What has no symbol of an
alphabet to replace (``--@--.--``) is no entity.

Defined cases: a null or empty text stays; repeated rows are rewritten alike;
texts of any length are read whole; an empty table gives no rows; all columns
are kept, and names starting with ``_pii_`` are the operator's own. The key is
the caller's secret: whoever has it can undo the permutations.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapreel.llm.common import staged

ROUNDS, WIDEN, FULL = 4, 8, 50
NATIONAL = 11           # digits of a phone number without a country code at most

# Patterns, titles and given names by gender and script.
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\w-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\w))")
SECRET = re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*[\"']?([A-Za-z0-9/+_=-]{8,})")
HEX = re.compile(r"(?<![A-Za-z0-9])(?=[0-9a-fA-F]*\d)(?=[0-9a-fA-F]*[a-fA-F])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+(?:[ -][A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+)*")
TITLE = re.compile(r"\b(Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Mme|Mlle|Sr|Sra|Señor|Señora|господин|госпожа|Господин|Госпожа)\.? $")
TITLES_F = {"Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Sra", "Señora", "госпожа", "Госпожа"}
GIVEN = {
    "f.latin": "Alice Anna Barbara Catherine Claire Daniela Elena Elizabeth Emily Francesca Helen Isabel Jennifer Julia Katharina Linda "
               "Lucia Margaret Maria Mary Monika Patricia Rachel Sarah Sophie Susan Teresa Ursula Valentina Victoria",
    "m.latin": "Alexander Andrew Antonio Bernard Charles Christopher Daniel David Edward Fernando François George Hans Henry James Jean "
               "John Joseph Jürgen Kevin Luis Matthew Michael Miguel Nicholas Paul Peter Robert Thomas William",
    "f.cyrillic": "Александра Анна Дарья Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна Юлия",
    "m.cyrillic": "Александр Алексей Андрей Владимир Дмитрий Иван Михаил Николай Олег Павел Пётр Сергей",
}
GIVEN = {kind: names.split() for kind, names in GIVEN.items()}
GENDER = {name: kind for kind, names in GIVEN.items() for name in names}
ALPHABETS = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "àáâäèéêëìíîïòóôöùúûü",
             "ÀÁÂÄÈÉÊËÌÍÎÏÒÓÔÖÙÚÛÜ", "ãåæçðñõøýþÿß", "ÃÅÆÇÐÑÕØÝÞ", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩЪЬ"]
LETTER = {c: (a, k) for a in ALPHABETS for k, c in enumerate(a)}
HEX_LETTER = {c: (a, k) for a in ("0123456789abcdef", "0123456789ABCDEF") for k, c in reversed(list(enumerate(a)))}


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Mentions ``start, end, kind, canonical`` in order, none overlapping."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in EMAIL.finditer(text)]
    if any(c in text for c in "0123456789"):
        for m in NUMBERS.finditer(text):
            kind, s = m.lastgroup, m[0]
            if kind == "ip":
                form = ".".join(str(int(x)) for x in s.split("."))
            else:
                form = "".join(c for c in s if c.isalnum())
                if kind == "phone" and s[0] not in "+(" and len(form) > NATIONAL:
                    continue                       # 1234-5678-9012: an order or a row of numbers
                if kind == "phone" and s.startswith("+"):
                    form = "+" + re.match(r"\+(\d{1,3})", s)[1] + "|" + form[len(re.match(r"\+(\d{1,3})", s)[1]):]
            found.append((m.start(), m.end(), kind, form))
        found += [(m.start(), m.end(), "secret", m[0]) for m in HEX.finditer(text)]
    if "=" in text or ":" in text:
        found += [(m.start(1), m.end(1), "secret", m[1]) for m in SECRET.finditer(text)]
    found += _people(text)
    kept, end = [], 0
    for m in sorted(found, key=lambda m: (m[0], -m[1])):
        if m[0] >= end and replaceable(*m[2:]):
            kept.append(m)
            end = m[1]
    return kept


def replaceable(kind: str, form: str) -> bool:
    """Whether a surrogate can differ from the form; an email keeps its last label."""
    return any(c in LETTER for c in (form.rpartition(".")[0] if kind == "email" else form))


def _script(word: str) -> str:
    return "cyrillic" if any("а" <= c.lower() <= "я" or c in "ёЁ" for c in word) else "latin"


def _people(text: str) -> list[tuple[int, int, str, str]]:
    found, surnames = [], set()
    runs = list(CAPITALS.finditer(text))
    for m in runs:
        words = [(m.start() + w.start(), w[0]) for w in re.finditer(r"[^ -]+", m[0])]
        title = TITLE.search(text, max(0, m.start() - 12), m.start())
        known = next((k for k, (_, w) in enumerate(words) if w in GENDER), None)
        if known is None and not title:
            continue
        given = words[known:known + 1] if known is not None else []
        rest = words[known + 1:known + 3] if known is not None else words[:2]
        if title and known is None and len(rest) == 2:           # an unlisted given name after a title
            gender = "f" if title[1] in TITLES_F else "m"
            at, w = rest.pop(0)
            found.append((at, at + len(w), f"given.{gender}.{_script(w)}", w))
        found += [(at, at + len(w), f"given.{GENDER[w]}", w) for at, w in given]
        for at, w in rest[:1] if known is not None else rest:
            surnames.add(w)
            found.append((at, at + len(w), f"surname.{_script(w)}", w))
    if surnames:
        taken = {m[0] for m in found}
        for m in runs:
            found += [(m.start() + w.start(), m.start() + w.end(), f"surname.{_script(w[0])}", w[0])
                      for w in re.finditer(r"[^ -]+", m[0]) if w[0] in surnames and m.start() + w.start() not in taken]
    return found


def _stream(key: bytes, label: str, n: int) -> list[int]:
    out = b""
    while len(out) < 4 * n:
        out += hashlib.blake2b(f"{label}|{len(out)}".encode(), key=key, digest_size=64).digest()
    return [int.from_bytes(out[4 * k:4 * k + 4], "big") for k in range(n)]


def permute(symbols: list[tuple[int, int]], key: bytes, label: str) -> list[int]:
    """Keyed permutation of a sequence of ``(value, radix)``: alternating halves are
    shifted by a keyed function of the other half, so it can be undone."""
    radix = [r for _, r in symbols]
    value = [v for v, _ in symbols]
    form = ",".join(map(str, radix))
    for r in range(ROUNDS):
        half, other = list(range(r % 2, len(value), 2)), list(range(1 - r % 2, len(value), 2))
        shifts = _stream(key, f"{label}|{r}|{form}|{[value[k] for k in other]}", len(half))
        for k, shift in zip(half, shifts):
            value[k] = (value[k] + shift) % radix[k]
    return value


def _letters(s: str, key: bytes, label: str, table=LETTER) -> str:
    places = [k for k, c in enumerate(s) if c in table]
    new = permute([(table[s[k]][1], len(table[s[k]][0])) for k in places], key, label)
    out = list(s)
    for k, v in zip(places, new):
        out[k] = table[s[k]][0][v]
    return "".join(out)


def luhn(digits: str) -> bool:
    total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def surrogate(kind: str, form: str, tweak: int, key: bytes) -> str:
    """The canonical form that stands for ``form``."""
    label = f"{kind}|{tweak}"
    more = 1 + (tweak - WIDEN) // 4 if tweak >= WIDEN else 0           # letters that widen a format
    if kind.startswith("given."):
        names = GIVEN.get(kind[6:], [])
        if form in names:
            order = sorted(names, key=lambda n: hashlib.blake2b(f"{label}|{n}".encode(), key=key).digest())
            return order[(order.index(form) + 1 + tweak) % len(names)]     # never itself
        return _letters(form + _more(form, more), key, label)
    if kind == "email":
        local, domain = form.split("@")
        labels = domain.split(".")
        return _letters(local + _more(local, more), key, label) + "@" + ".".join([*(_letters(x, key, f"domain|{tweak}") for x in labels[:-1]), labels[-1]])
    if kind == "ip":
        return ".".join(map(str, permute([(int(x), 256) for x in form.split(".")], key, label)))
    if kind == "phone" and "|" in form:
        country, rest = form.split("|")
        return country + "|" + _letters(rest, key, label + country)
    if kind == "card" and luhn(form):
        body = form[0] + _letters(form[1:-1], key, label)
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "iban":
        return form[:2] + _letters(form[2:], key, label + form[:2])
    if kind == "secret" and all(c in HEX_LETTER for c in form) and (form.lower() == form or form.upper() == form):
        alphabet = "0123456789ABCDEF" if form != form.lower() else "0123456789abcdef"
        return _letters(form + "0" * more, key, label + alphabet[-1], {c: (alphabet, k) for k, c in enumerate(alphabet)})
    if kind == "secret" or kind.startswith("surname."):
        form += _more(form, more)
    return _letters(form, key, label)


def _more(form: str, n: int) -> str:
    return (("на" if _script(form) == "cyrillic" else "na") * n)[:n]


def render(mention: str, kind: str, new: str) -> str:
    """``new`` in the mention's separators and case."""
    if kind in ("phone", "card", "ssn", "iban"):
        symbols = iter(c for c in new if c.isalnum())
        return "".join(next(symbols) if c.isalnum() else c for c in mention)
    if kind == "email":
        return new.upper() if mention.isupper() else new
    return new


def entities(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``kind, form, surrogate, tweak`` of every distinct entity, free of collisions."""
    def detect(batches):
        for batch in batches:
            seen = sorted({m[2:] for t in batch.column(0).to_pylist() if t for m in find(t)})
            yield pa.RecordBatch.from_arrays([pa.array([s[k] for s in seen], pa.string()) for k in (0, 1)], ["kind", "form"])

    def replace(batches):
        for batch in batches:
            kinds, forms, tweaks = (batch.column(k).to_pylist() for k in range(3))
            new = [surrogate(*e, key) for e in zip(kinds, forms, tweaks)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(new, pa.string())],
                                             ["kind", "form", "tweak", "surrogate"])
    originals = staged(docs.select(text_col).mapInArrow(detect, "kind string, form string").distinct(), "pii-entities")
    state = originals.withColumn("tweak", F.lit(0))
    given = F.col("kind").startswith("given.")
    # listed names are one ring, in which no two meet: they come before the names that are not listed
    unlisted = given & ~F.col("form").isin(sorted(GENDER))
    wide = given | F.col("kind").startswith("surname.") | F.col("kind").isin("email", "secret")
    while True:                            # each tweak frees most of those left: names widen, the other formats are large
        state = staged(state.select("kind", "form", "tweak").mapInArrow(
            replace, "kind string, form string, tweak int, surrogate string"), "pii-surrogates")
        real = originals.select("kind", F.col("form").alias("surrogate"), F.lit(True).alias("real"))
        shared = state.groupBy("kind", "surrogate").agg(F.min(F.struct(unlisted.alias("unlisted"), "form"))["form"].alias("owner"))
        judged = state.join(real, ["kind", "surrogate"], "left").join(shared, ["kind", "surrogate"])
        # a given name comes from a list that the corpus may use up: there only sharing is a collision
        free = given | (~wide & (F.col("tweak") >= FULL))
        taken = (F.coalesce("real", F.lit(False)) & ~free) | (F.col("owner") != F.col("form")) | (F.col("surrogate") == F.col("form"))
        judged = staged(judged.select("kind", "form", "tweak", "surrogate", taken.alias("taken")), "pii-judged")
        if judged.where("taken").first() is None:
            return judged.drop("taken")
        state = judged.withColumn("tweak", F.col("tweak") + F.col("taken").cast("int"))


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in its text and ``_pii_found``, the number of mentions."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    tweaked = entities(docs, key, text_col).where(F.col("tweak") > 0).select("kind", "form", "tweak")

    def mentions(batches):
        for batch in batches:
            rows = [(i, m, *e) for i, m, t in zip(*(c.to_pylist() for c in batch.columns)) for e in sorted({x[2:] for x in find(t)})]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.string(), pa.string()))], ["doc_id", "mark", "kind", "form"])

    marked = docs.withColumn("_pii_mark", F.xxhash64(text))
    tweaked = staged(tweaked, "pii-tweaked")
    if tweaked.first() is None:
        marked = marked.withColumn("_pii_tweaks", F.lit(None).cast("array<struct<kind:string,form:string,tweak:int>>"))
    else:
        used = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
        used = used.mapInArrow(mentions, "doc_id bigint, mark bigint, kind string, form string").distinct().join(tweaked, ["kind", "form"])
        used = used.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("kind", "form", "tweak")).alias("_pii_tweaks"))
        used = staged(used.select(F.col("doc_id").alias("_pii_id"), F.col("mark").alias("_pii_key"), "_pii_tweaks"), "pii-used")
        on = F.col(id_col).cast("bigint").eqNullSafe(F.col("_pii_id")) & (F.col("_pii_mark") == F.col("_pii_key"))
        marked = marked.join(used, on, "left").drop("_pii_id", "_pii_key")

    def rewrite(batches):
        for batch in batches:
            texts, counts = [], []
            for t, tweaks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = find(t) if t else []
                other = {(x["kind"], x["form"]): x["tweak"] for x in tweaks or ()}
                parts, end = [], 0
                for a, b, kind, form in found:
                    parts += [t[end:a], render(t[a:b], kind, surrogate(kind, form, other.get((kind, form), 0), key))]
                    end = b
                texts.append("".join(parts) + t[end:] if found else t)
                counts.append(len(found))
            rest = batch.columns[2:]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                                             [*batch.schema.names[2:], "_pii_text", "_pii_found"])
    rest = [c for c in docs.columns if c != text_col]
    flat = marked.select(F.col(text_col).alias("_pii_in"), "_pii_tweaks", *rest)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema)
    done = flat.mapInArrow(rewrite, f"{schema + ', ' if schema else ''}_pii_text string, _pii_found bigint")
    return done.select(*[F.col("_pii_text").alias(c) if c == text_col else F.col(c) for c in docs.columns], "_pii_found")
