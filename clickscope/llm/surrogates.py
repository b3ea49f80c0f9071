"""Personal data: every detected entity is replaced by a keyed surrogate of the same type and format.

Detection is by patterns (mail addresses, phone, card and account numbers, IP addresses, social security numbers,
secrets, names after a title). A surrogate is drawn from an HMAC of (type, normalised value, attempt): digits stay
digits, letters stay letters of the same case, separators, country codes, key prefixes and top-level domains stay, IP
octets stay in range, card numbers that satisfy the check digit still do. Given names are drawn from lists by gender
(from the title) and script, surnames are built from syllables of the script; every part of a name has its own
surrogate, so "Ms Ada Moss" and "Ms Moss" still agree. Names may be of any length, with initials and particles (which
stay), over any white space but an empty line; the parts of a name found after a title are replaced wherever else they
stand in the same text, also without the title. Not detected: names that never follow one of ``TITLES`` in their text,
parts in another spelling or case, suffixes such as Jr, and names in scripts without capitals.

Coreference holds across the corpus because a surrogate depends on the value only. Distinctness is checked across the
corpus: in rounds, values that share a surrogate with another value, or whose surrogate is an original value of the
corpus, draw again (the smallest earlier attempt stays), until none is left. The table of distinct entities is
distributed; only documents with entities are joined with it.

Defined cases: null and empty texts stay as they are; texts without entities are returned unchanged; repeated rows
get equal replacements; an empty table gives an empty result; all columns of the input stay, whatever their names.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import math
import re
import unicodedata
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, gapless_rank, quoted

MAX_ROUNDS = 30
LISTED = 4096  # values of a format that one row lists
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"

# Titles and the gender they tell (f, m, or n where they don't), per language
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "n", "Prof": "n", "Herr": "m", "Herrn": "m",
          "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f",
          "Señorita": "f", "Sra": "f", "Don": "m", "Doña": "f", "господин": "m", "госпожа": "f", "г-н": "m",
          "г-жа": "f", "κύριος": "m", "κυρία": "f"}
# Given names by script and gender
GIVEN = {("latin", "f"): "Anna Clara Elena Julia Laura Maria Nora Paula Sara Vera Alma Edith Flora Greta Helena Ida",
         ("latin", "m"): "Adam Bruno David Emil Felix Hugo Jonas Leon Martin Oscar Paul Simon Tomas Victor Anton Karl",
         ("latin", "n"): "Alex Andrea Chris Dana Kim Lou Mika Noa Robin Sam Toni Jules Kaya Nikola Sascha Remy",
         ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Софья Татьяна",
         ("cyrillic", "m"): "Алексей Борис Виктор Глеб Денис Иван Максим Олег Павел Сергей",
         ("cyrillic", "n"): "Саша Женя Валя Шура Слава",
         ("greek", "f"): "Άννα Ελένη Μαρία Σοφία Ειρήνη", ("greek", "m"): "Γιώργος Νίκος Πέτρος Ανδρέας Κώστας",
         ("greek", "n"): "Αλεξ Χρις"}
# Syllables for surnames
SYLLABLES = {"latin": "bar den fol gri hal kes lor mar nel pol ros sten tal ver wic zan bro dul fen gar".split(),
             "cyrillic": "бор вел гор дан зим кор лав мар нов пет ров сол тим фед".split(),
             "greek": "αλ βασ γερ δημ καρ λεον μαν παπ στεφ φωτ".split()}

_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
_NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
PATTERNS = [
    ("email", r"(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}"),
    ("secret", r"\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_\w{20,}|sk-\w{16,}|xox[abp]-[\w-]{10,})\b"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key)\s*[=:]\s*[\"']?)(?P<quoted>[\w+/=.-]{6,})"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("phone", r"(?<![\d+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,5}(?!\d)"),
    ("phone", r"(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"),
    ("card", r"(?<![\d.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]?\d{1,3})?)(?![\d-])"),
]
DIGIT_PATTERNS = re.compile("|".join(f"(?P<t{i}_{t}>{p.replace('?P<quoted>', f'?P<q{i}>')})"
                                     for i, (t, p) in enumerate(PATTERNS)))
TITLE = re.compile(rf"(?<!\w)(?P<title>{_TITLE})\.?(?=\s)")
_NEXT_WORD = re.compile(rf"(\s*)({_NAME})(\.?)")
_WORD = re.compile(rf"(?<!\w){_NAME}(?!\w)")
_PARAGRAPH = re.compile(r"\n\s*\n")
# Lower-case words inside names, words after which a full stop ends no sentence, what follows a name,
# titles that are given names too, and words that start sentences
PARTICLES = set("van von der den dem de del della dello di da do dos das du des la le las los ter ten te zu zum zur af "
                "av bin ibn bint ben al el y e ap ди де ван фон".split())
ABBREVIATED = {"St", "Ste", "Wm", "Chas", "Geo", "Jas", "Jos", "Thos"}
SUFFIXES = {"Jr", "Sr", "II", "III", "IV", "PhD", "MD", "Esq"}
NAMES_TOO = {"Don", "Doña"}
STARTERS = set("A An The This That These Those In On At By For From To Of With And But Or So If When While As After "
               "Before He She It They We You I His Her Its Their Our My Your There Here Not No Yes Is Was Are Were What "
               "Who Why How Where Der Die Das Ein Eine Er Sie Es Wir Ihr Und Aber In Im Am Auf Mit Von Nach Le La Les "
               "Un Une Il Elle Ils Nous Vous Et Mais Dans El Los Las Una Y Pero En В Во На Он Она Они Мы Вы И Но А Я "
               "Ο Η Το Οι Τα Και Στο Στη".split())
_MARKS = "@0123456789"
_ANY_DIGIT = re.compile(r"\d")
_SECRET_WORDS = ("password", "passwd", "pwd", "token", "secret", "api")
_ANY_SECRET_WORD = re.compile(f"(?i:{'|'.join(_SECRET_WORDS)})")  # also the letters that only (?i) equates, as in apı
_SECRET_HEADS = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xoxa-", "xoxb-", "xoxp-")
_HEADED_SECRET = re.compile(PATTERNS[1][1])
_CHEAP_TITLES = tuple(TITLES)


def _marked(text: str) -> bool:
    """Plain searches that tell whether ``PATTERNS`` can match: they need a decimal digit of any script, an @, the
    head of a secret, or the name of a secret with = or :."""
    if any(ch in text for ch in _MARKS) or not text.isascii() and _ANY_DIGIT.search(text):
        return True
    if "=" in text or ":" in text:
        low = text.lower()
        if any(w in low for w in _SECRET_WORDS) or not text.isascii() and _ANY_SECRET_WORD.search(text):
            return True
    return any(x in text for x in _SECRET_HEADS) and _HEADED_SECRET.search(text) is not None


def _name_after(text: str, pos: int) -> tuple[list[tuple[int, int, bool]], str | None, int]:
    """(start, end, is an initial) of the parts of the name at ``pos``, a further title before it, and its end.

    A name is a row of capitalised words, initials and particles; it ends at a lower-case word, at punctuation (a full
    stop after an initial is none), at an empty line, and at a word that starts sentences on a new line or behind a full
    stop.
    """
    parts: list[tuple[int, int, bool]] = []
    title, end, stop = None, pos, False
    while m := _NEXT_WORD.match(text, pos):
        gap, w, dot = m.groups()
        if not gap and not stop or _PARAGRAPH.search(gap):
            break
        if w in TITLES and w not in NAMES_TOO:
            if parts:
                break
            title, stop = w, bool(dot)
        elif w[0].isupper():
            initial = len(w) == 1
            starts = w in STARTERS and not (initial and dot) and (gap and stop or "\n" in gap)
            if parts and (w in SUFFIXES or starts):
                break
            owner = re.search("['’]s$", w) is not None
            stop = bool(dot) and (initial or w in ABBREVIATED)
            end = m.end(2) - 2 * owner
            parts.append((m.start(2), end, initial))
            if owner or dot and not stop:
                break
        elif w in PARTICLES and not dot:
            stop = False
        else:
            break
        pos = m.end()
    return parts, title, end


def _persons(text: str) -> list[tuple[int, int, str, str]]:
    """The parts of names after a title, and every other occurrence of these parts in the text, under one kind each.

    The kind comes from the first name of several parts that has the word; a name of one part is a surname.
    """
    names, upto = [], 0
    for m in TITLE.finditer(text):
        if m.start() >= upto:
            parts, title, upto = _name_after(text, m.end())
            if parts:
                names.append((parts, TITLES[title if title and TITLES[title] != "n" else m.group("title")]))
    kinds: dict[str, str] = {}
    out: dict[tuple[int, int], str] = {}
    for parts, gender in sorted(names, key=lambda x: len(x[0]) == 1):
        last = max((i for i, x in enumerate(parts) if not x[2]), default=-1)
        for i, (a, b, initial) in enumerate(parts):
            w = text[a:b]
            out[a, b] = "initial" if initial else kinds.setdefault(w, "surname" if i == last else f"given_{gender}")
    for w in STARTERS & kinds.keys():
        del kinds[w]
    if kinds:
        for m in _WORD.finditer(text):
            for a, b in _known_parts(m.group(), m.start(), kinds):
                out.setdefault((a, b), kinds[text[a:b]])
    return _disjoint([(a, b, kind, text[a:b]) for (a, b), kind in out.items()])


def _known_parts(word: str, at: int, kinds: dict[str, str]) -> Iterator[tuple[int, int]]:
    """Places of known name parts: the whole word, or what lies between its hyphens and apostrophes."""
    if word in kinds:
        yield at, at + len(word)
    elif re.search("['’-]", word):
        head = re.sub("['’]s$", "", word)
        if head in kinds:
            yield at, at + len(head)
        else:
            yield from ((at + m.start(), at + m.end()) for m in re.finditer("[^'’-]+", word) if m.group() in kinds)


def _disjoint(found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Left to right; of overlapping spans the first and longest stays."""
    out: list[tuple[int, int, str, str]] = []
    for x in sorted(found, key=lambda x: (x[0], -x[1])):
        if not out or out[-1][1] <= x[0]:
            out.append(x)
    return out


def spans(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, type, normalised value) of the entities, left to right, without overlaps."""
    out: list[tuple[int, int, str, str]] = []
    if not text:
        return out
    if _marked(text):
        for m in DIGIT_PATTERNS.finditer(text):
            group = m.lastgroup if m.lastgroup.startswith("t") else next(
                g for g, v in m.groupdict().items() if g.startswith("t") and v is not None)
            i, kind = group[1:].split("_")
            inner = m.groupdict().get(f"q{i}")
            a, b = m.span(f"q{i}") if inner is not None else m.span()
            out.append((a, b, kind, text[a:b].lower() if kind == "email" else text[a:b]))
    if any(t in text for t in _CHEAP_TITLES):
        taken = sorted(out)
        starts = [x[0] for x in taken]
        for a, b, kind, w in _persons(text):
            at = bisect.bisect_left(starts, b)  # the entities before it end in order, as they don't overlap
            if not at or taken[at - 1][1] <= a:
                out.append((a, b, kind, w))
    return sorted(out)


def _stream(key: bytes, *parts) -> Iterator[int]:
    """Endless keyed 16-bit numbers for these parts."""
    n = 0
    while True:
        d = hmac.new(key, "\x1f".join(map(str, (*parts, n))).encode(), hashlib.sha256).digest()
        yield from (int.from_bytes(d[i:i + 2], "big") for i in range(0, 32, 2))
        n += 1


def _shape(s: str) -> list[Sequence[str]]:
    """The choices for each character: digits to digits, Latin letters to letters of the same case, the rest stays."""
    out: list[Sequence[str]] = []
    for ch in s:
        if ch.isdigit():
            out.append(_DIGITS)
        elif "a" <= ch <= "z":
            out.append(_LOWER)
        elif "A" <= ch <= "Z":
            out.append(_LOWER.upper())
        elif ch.isalpha():
            out.append("AEIOU" if ch.isupper() else "aeiou")
        else:
            out.append([ch])
    return out


def _draw(slots: list[Sequence[str]], r: Iterator[int]) -> str:
    return "".join(x[next(r) % len(x)] if len(x) > 1 else x[0] for x in slots)


def luhn(digits: str) -> int:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def script_of(word: str) -> str:
    c = ord(next((ch for ch in word if ch.isalpha()), "a"))
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 or 0x1F00 <= c < 0x2000 else "latin"


def _with_check_digit(number: str) -> str:
    """Ends in the digit that satisfies the check (the last character is a digit)."""
    return next(c for c in (number[:-1] + d for d in _DIGITS) if luhn(re.sub(r"\D", "", c)) == 0)


def _other_initial(key: bytes, letter: str) -> str:
    """A keyed shift within the alphabet; never the letter itself, different for different letters, marks stay."""
    base, *marks = unicodedata.normalize("NFD", letter)
    for first, n in (("A", 26), ("А", 32), ("Α", 17), ("Σ", 7)):
        i = ord(base) - ord(first)
        if 0 <= i < n:
            base = chr(ord(first) + (i + 1 + next(_stream(key, "initial", first)) % (n - 1)) % n)
            break
    else:
        base = "AEIOU"[next(_stream(key, "initial", base)) % 5]
    return unicodedata.normalize("NFC", base + "".join(marks))


def slots_of(key: bytes, kind: str, value: str, longer: int = 0) -> list[Sequence[str]]:
    """The format of a value's surrogates: the choices for each place, ``longer`` places more than the value has.

    Names get syllables as further places, IP addresses any octets (and no more than that), the rest digits.
    """
    more: list[Sequence[str]] = [_DIGITS] * longer
    if kind == "email":
        user, _, host = value.partition("@")
        labels = host.split(".")
        # the host's surrogate depends on the host only, so that colleagues stay colleagues
        h = _stream(key, "host", host, 0)
        return [*_shape(user), *more, [f"@{'.'.join([_draw(_shape(x), h) for x in labels[:-1]] + labels[-1:])}"]]
    if kind == "ip":
        if longer > 1:
            raise ValueError("all IPv4 addresses are taken: as originals of the corpus or as surrogates")
        low, high = {1: 0, 2: 10, 3: 100}, {1: 9, 2: 99, 3: 255}
        octets = [range(256) if longer else range(low[len(x)], high[len(x)] + 1) for x in value.split(".")]
        return [x for o in octets for x in ([str(i) for i in o], ["."])][:-1]
    if kind == "phone":
        m = re.match(r"\+\d{1,3}(?=\D)", value)
        head = m.group() if m else ""
        return [[head], *_shape(value[len(head):]), *more]
    if kind == "card" and luhn(re.sub(r"\D", "", value)) == 0:
        return [*_shape(value[:-1]), *more, ["0"]]  # the check digit follows from the others
    if kind == "iban":
        return [[value[:2]], *_shape(value[2:]), *more]
    if kind == "secret":
        m = re.match(r"AKIA|gh[pousr]_|sk-|xox[abp]-", value)
        head = m.group() if m else ""
        if not head and re.fullmatch(r"[0-9a-f]+", value):
            return ["0123456789abcdef"] * (len(value) + longer)
        return [[head], *_shape(value[len(head):]), *more]
    if kind.startswith("given_"):
        script = script_of(value)
        return [GIVEN[script, kind[-1]].split(), *[SYLLABLES[script]] * longer]
    if kind == "surname":
        syl = SYLLABLES[script_of(value)]
        return [[x.capitalize() for x in syl], *[syl] * (2 + longer)]
    return [*_shape(value), *more]


def _finished(kind: str, value: str, drawn: str) -> str:
    return _with_check_digit(drawn) if kind == "card" and luhn(re.sub(r"\D", "", value)) == 0 else drawn


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """A draw from the value's format; names get more syllables with the attempts, so they never run out."""
    if kind == "initial":
        return _other_initial(key, value)
    longer = attempt if kind.startswith("given_") else attempt // 4 if kind == "surname" else 0
    return _finished(kind, value, _draw(slots_of(key, kind, value, longer), _stream(key, kind, value, attempt)))


def format_of(key: bytes, kind: str, value: str, longer: int) -> tuple[str, int]:
    """A name for the format, equal for values that share it, and the number of its values."""
    slots = slots_of(key, kind, value, longer)
    checked = kind == "card" and luhn(re.sub(r"\D", "", value)) == 0
    name = hashlib.md5("\x1e".join([str(checked), *("\x1f".join(x) for x in slots)]).encode()).hexdigest()
    return name, math.prod(len(x) for x in slots)


def nth_of_format(key: bytes, kind: str, value: str, longer: int, n: int) -> str:
    """The n-th value of the format of ``value`` in a keyed order; n below the format's size gives different values."""
    slots = slots_of(key, kind, value, longer)
    name, size = format_of(key, kind, value, longer)
    r = _stream(key, "order", kind, name)
    step, start = (sum(next(r) << 16 * i for i in range(size.bit_length() // 16 + 2)) % size for _ in range(2))
    while math.gcd(step, size) != 1:
        step += 1
    at, out = (start + n * step) % size, []
    for x in slots:
        at, i = divmod(at, len(x))
        out.append(x[i])
    return _finished(kind, value, "".join(out))


def _found(text: Column) -> Column:
    @F.pandas_udf("array<struct<kind:string,value:string>>")
    def found(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [{"kind": k, "value": v} for k, v in dict.fromkeys(x[2:] for x in spans(t))])
    return found(text)


def _drawn(key: bytes) -> Column:
    @F.pandas_udf("string")
    def drawn(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, *x) for x in zip(kind, value, attempt, strict=True)], dtype="object")
    return drawn("kind", "value", "attempt")


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """Distinct (kind, value) → surrogate; no two values of a kind share one, none equals an original value.

    Initials are apart: an alphabet has no letters to spare, so they are shifted within it.
    """
    state = cut(entities.select("kind", "value").distinct().withColumn("attempt", F.lit(0))
                .withColumn("surrogate", _drawn(key)))
    originals = state.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("taken"))
    by = Window.partitionBy("kind", "surrogate").orderBy("attempt", "value")
    for n in range(1, MAX_ROUNDS + 1):
        judged = (state.withColumn("rn", F.row_number().over(by)).join(originals, ["kind", "surrogate"], "left")
                  .withColumn("again", ((F.col("rn") > 1) | F.col("taken").isNotNull()) & (F.col("kind") != "initial"))
                  .select("kind", "value", "attempt", "surrogate", "again"))
        if judged.where("again").isEmpty():
            return state.drop("attempt")
        kept = judged.where(~F.col("again")).drop("again")
        redrawn = judged.where("again").select("kind", "value", F.lit(n).alias("attempt"))
        if n < MAX_ROUNDS:
            state = cut(kept.unionByName(redrawn.withColumn("surrogate", _drawn(key))))
    return _filled(cut(kept.select("kind", "value", "surrogate")), cut(redrawn.select("kind", "value")), key)


def _filled(kept: DataFrame, left: DataFrame, key: bytes) -> DataFrame:
    """``kept`` and the values ``left``, which get the free values of their formats by rank.

    Values stay without a surrogate for many draws only where their format is nearly full. As many values of a format
    are listed as can be taken or needed (or all, if it has no more); those that are no surrogate or original yet are
    matched with the values left, by distributed ranks. Where there are fewer of them, the format is full and the
    values over get one place more. Formats may overlap, so equal picks leave one and the others go on.
    """
    values = cut(kept.select("kind", "value").unionByName(left))
    left = left.withColumn("longer", F.lit(0))

    @F.pandas_udf("struct<format:string,size:bigint,turn:string>")
    def formats(kind: pd.Series, value: pd.Series, longer: pd.Series) -> pd.DataFrame:
        rows = [format_of(key, *x) for x in zip(kind, value, longer, strict=True)]
        turn = [hmac.new(key, f"turn\x1f{v}".encode(), hashlib.sha256).hexdigest() for v in value]
        return pd.DataFrame([(f, min(n, 1 << 62), t) for (f, n), t in zip(rows, turn, strict=True)],
                            columns=["format", "size", "turn"])

    @F.pandas_udf("string")
    def nth(kind: pd.Series, value: pd.Series, longer: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([nth_of_format(key, k, v, int(m), int(i))
                          for k, v, m, i in zip(kind, value, longer, n, strict=True)], dtype="object")

    while not left.isEmpty():
        named = cut(left.withColumn("f", formats("kind", "value", "longer")).select("kind", "value", "longer", "f.*")
                    .withColumn("format", F.concat_ws("|", "kind", "format")))
        bound = values.groupBy("kind").agg((2 * F.count(F.lit(1))).alias("bound"))
        listed = (named.groupBy("kind", "format").agg(F.min(F.struct("value", "longer", "size")).alias("s"))
                  .join(F.broadcast(bound), "kind")
                  .select("kind", "format", "s.value", "s.longer", F.least("s.size", "bound").alias("upto"))
                  .withColumn("first", F.explode(F.sequence(F.lit(0), F.col("upto") - 1, F.lit(LISTED)))))
        listed = (listed.repartition("format", "first")
                  .withColumn("n", F.explode(F.sequence("first", F.least(F.col("first") + LISTED, "upto") - 1)))
                  .select("kind", "format", nth("kind", "value", "longer", "n").alias("value")).distinct())
        taken = kept.select("kind", F.col("surrogate").alias("value")).unionByName(values)
        free = listed.join(taken, ["kind", "value"], "left_anti").withColumn("turn", F.md5("value"))
        free, asked = (gapless_rank(x.withColumn("c", F.lit(0)).withColumn("d", F.substring("turn", 1, 3)),
                                    "format", "c", "d", [F.col("turn"), F.col("value")], "rank") for x in (free, named))
        picked = cut(asked.select("kind", "value", "longer", "format", "rank")
                     .join(free.select("format", "rank", F.col("value").alias("surrogate")), ["format", "rank"], "left"))
        once = Window.partitionBy("kind", "surrogate").orderBy("value")
        placed = picked.where("surrogate IS NOT NULL").withColumn("rn", F.row_number().over(once))
        full = picked.where("surrogate IS NULL").withColumn("longer", F.col("longer") + 1)
        kept = cut(kept.unionByName(placed.where("rn = 1").select("kind", "value", "surrogate")))
        left = cut(full.unionByName(placed.where("rn > 1").drop("rn")).select("kind", "value", "longer"))
    return kept


def replace_entities(docs: DataFrame, key: bytes, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """``docs`` with every entity of ``text_col`` replaced; ``found_col`` names an added count of replaced spans."""
    text = F.col(quoted(text_col))
    found, h, of, pairs, n = fresh(docs, "found", "text_hash", "of_hash", "pairs", "n_found")
    rows = docs.withColumn(found, _found(text))
    touched = rows.where(F.size(found) > 0).withColumn(h, F.md5(text.cast("binary")))
    each = cut(touched.select(F.col(h).alias("h"), F.explode(found).alias("e")).select("h", "e.*").distinct())
    known = assign(each, key)
    mapping = (each.join(known, ["kind", "value"])
               .groupBy(F.col("h").alias(of)).agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias(pairs)))

    @F.pandas_udf("struct<text:string,n:int>")
    def applied(s: pd.Series, p: pd.Series) -> pd.DataFrame:
        out = []
        for t, maps in zip(s, p, strict=True):
            to = {(x["kind"], x["value"]): x["surrogate"] for x in maps}
            done, last, k = [], 0, 0
            for a, b, kind, value in spans(t):
                done += [t[last:a], to[kind, value]]
                last, k = b, k + 1
            out.append(("".join(done) + t[last:], k))
        return pd.DataFrame(out, columns=["text", "n"])

    joined = touched.join(mapping, F.col(h) == F.col(of)).withColumn(n, applied(text, F.col(pairs)))
    count = [F.col(f"{n}.n").alias(found_col)] if found_col else []
    zero = [F.lit(0).alias(found_col)] if found_col else []
    new = joined.select(*[F.col(f"{n}.text").alias(c) if c == text_col else F.col(quoted(c)) for c in docs.columns
                          if c != found_col], *count)
    same = rows.where(F.size(found) <= 0).select(*[F.col(quoted(c)) for c in docs.columns if c != found_col], *zero)
    return same.unionByName(new)
