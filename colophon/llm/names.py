"""Variant spellings of names typed by people (problem 6).

1. Names are brought to a plain form: garbled and disguised letters undone, case and accents dropped, titles and particles set aside.
   An entry has a key, its surname or the proper name of a body, and the tokens beside it.  Where name parts may stand in
   another order, it has further readings with another key (``exchanged``).
2. Entries alike in all that is compared form one class; all later steps work on classes.
3. The symmetric-delete index: every distinct key is stored under its beginning with up to two letters left out, and keys that meet under
   one such form are verified by their edit distance (exchanged neighbours counting once).  So near keys are found without
   comparing all.
4. Classes under near keys meet if their years lie close together and a token of one meets a token of the other in an index of the
   same kind: names under the name they are a form of, else with letters left out, initials and abbreviations under their first
   letter.  So a surname that a third of all have is split by given names and years.  Of those that meet, the
   tokens of the shorter name are assigned to those of the longer one, each to another, at least cost; equal, short form,
   initial, abbreviation and slip of the pen all fit.
5. Classes so linked form groups, found by passing the least class id along links until nothing changes.

Years: entries of one person begin within ``BEGIN`` and end within ``END`` years of each other; an unknown year is no contradiction, but one of the two must
be known on both sides, so an entry without any year is linked to nothing.  Namesakes of other generations therefore never meet.

Defined results: an entry without any name takes its name from the title; without either, it is linked to nothing; repeated
deliveries count once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.llm import garbled, lookalike
from colophon.session import cut

# years that the first, and the last, years of one person's entries differ by at most
BEGIN, END = 3, 2
WIDE = 12
# stands for a lost character inside a token and is like every letter
ANY = "\u0294"
PREFIX = 14
# how far a reading with name parts in another order is to be trusted
MAYBE, SURE = 1, 2

# fixed values
TITLES = frozenset("mr dr jhr jkhr jonkheer baron heer graaf ridder ds prof ir".split())
PARTICLES = frozenset("van de den der von vande vanden vander v d vd ter ten te op opden in int t du la le der het".split())
BODY_WORDS = frozenset("gilde zevaarders zeevaarders rad raad compagnie societeit kamer college kophandel koophandel directie handel staten admiraliteit".split())
SHORT_FORMS = {
    "abraham": "bram abram", "adrian": "arjen adrianus adrian ad", "antonius": "teun anton anthonie anthoni toon antoon", "balthasar": "balten baltus",
    "benedictus": "bendix bene benedikt ben benoit", "catharina": "catrin kaatje katrin trin trijntje katarina cato", "conrad": "kon conradus koenraad kon koen coen conraad koenrad", "cornelis": "kees cornelius cor nelis",
    "daniel": "daan daneel", "dorothee": "doortje dorothea dora dortje", "eleonore": "noor eleonora nora leonore", "elisabeth": "betje lisbet lijsbet lisbeth", "everard": "evert everhard everhardus everardus",
    "francois": "frans franciscus francoi francis", "frederik": "frits frederick fredrik frederic freek", "gerard": "gerrit gerhard gerardus gerhardus geert", "gunther": "gunter guntherus", "hendrik": "hein henrik hendrick heindrik rik",
    "isbrand": "isbrant ijsbrand isebrand isbrandus", "jacobus": "koos jaap jacob jac cobus jakob", "jerome": "jeron hieronimus jeroen", "johannes": "jan johan hans joannes joan", "jol": "joel jole", "jurgen": "jurriaan jorgen jurrian juren georgius joris",
    "lambert": "lambertus lammert bert", "laurens": "lourens laurentius lau laurentis laurenz louw", "leonard": "lenart leendert leonardus", "margaretha": "griet margriet grietje margreta margareta", "matthias": "mathis matthis thijs this mathijs matthijs",
    "maximilian": "max maximilianus maximiliaan", "michal": "chiel michiel michael machiel michel", "nicolas": "clas klaas claas nicolaus nicolaas klas niclaas nico", "otto": "otho", "philippus": "filips philip flip philips", "pieter": "piet petrus pietersz peter",
    "rafal": "raphael rafael raphal", "rene": "reinier renatus renee", "rutger": "rogier rutgerus rutgert", "sebastien": "bas sebastiaan sebastianus bastian bastiaan sebastian", "simon": "simen simeon siemen symen", "theodorus": "theo diederik dirk theodor door",
    "therese": "trees theresia teresa theresa", "ulrich": "ulricus ulrik", "wilhelmus": "willem wim wilhelm wm", "zacharias": "zacharie zach zaccharias sacharias",
}


def plain(text: str) -> str:
    """Lower case without accents."""
    text = unicodedata.normalize("NFD", text.casefold().replace("ø", "o").replace("ß", "ss").replace("æ", "ae").replace("œ", "oe"))
    return "".join(c for c in text if not unicodedata.combining(c))


def bare(text: str) -> str:
    """The plain form; letters that are spelt in two ways become one."""
    text = plain(text).replace("ij", "y").replace("y", "i")
    for two, one in (("ae", "a"), ("oe", "o"), ("ue", "u"), ("aa", "a"), ("ee", "e")):
        text = text.replace(two, one)
    return text


_CANON = {bare(v): bare(k) for k, vs in SHORT_FORMS.items() for v in (*vs.split(), k)}
_FORMS: dict[str, tuple[str, ...]] = {}
for _v, _k in _CANON.items():
    _FORMS[_k] = (*_FORMS.get(_k, ()), _v)
# forms as they are written too, for slips inside letters that are else read as one
for _k, _vs in SHORT_FORMS.items():
    _FORMS[bare(_k)] = tuple(dict.fromkeys((*_FORMS[bare(_k)], *_vs.split(), _k)))
_T, _P, _B = (frozenset(map(bare, words)) for words in (TITLES, PARTICLES, BODY_WORDS))
_TOKEN = re.compile(r"[^\W\d_]+\.?")


def key_form(token: str) -> str:
    """A bare word without the spellings that sound alike."""
    for two, one in (("ck", "k"), ("c", "k"), ("z", "s"), ("th", "t"), ("dt", "t"), ("gh", "g"), ("ph", "f")):
        token = token.replace(two, one)
    return re.sub(r"(.)\1+", r"\1", token.replace(ANY, ""))


_BK = frozenset(map(key_form, _B))


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with exchanged neighbours counting once, within a band; ``most + 1`` if it is greater."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    far = most + 1
    older: dict[int, int] = {}
    old = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        row: dict[int, int] = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            if not j:
                row[0] = i
                continue
            y = b[j - 1]
            d = min(old.get(j, far) + 1, row.get(j - 1, far) + 1, old.get(j - 1, far) + (x != y and x != ANY and y != ANY))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older.get(j - 2, far) + 1)
            row[j] = d
        if min(row.values()) > most:
            return far
        older, old = old, row
    return min(old.get(len(b), far), far)


def slack(n: int) -> int:
    """Edits that a word of n letters may differ by."""
    return 0 if n < 4 else 1 if n < 7 else 2


def leave_out(key: str) -> set[str]:
    """The beginning of the key, and the same with up to as many letters left out as the key may differ by.

    Near keys meet in one such form: an edit leaves out at most a letter on either side, the one that differs or the last of the
    beginning.  So long keys have no more forms than others.
    """
    fresh = {key[:PREFIX]}
    out = set(fresh)
    for _ in range(slack(len(key))):
        fresh = {k[:i] + k[i + 1 :] for k in fresh for i in range(len(k))}
        out |= fresh
    return out


def _subsequence(a: str, b: str) -> bool:
    at = iter(b)
    return all(c in at for c in a)


def _abbreviates(short: str, form: str) -> bool:
    """Whether a word with a point is an abbreviation of a form, with a slip at most."""
    n = len(short)
    if short[0] != form[0]:
        return False
    return form.startswith(short) or n > 2 and distance(short, form[:n], 1) < 2 or n > 3 and distance(short, form[: n - 1], 1) < 2 or n <= 3 and _subsequence(short, form)


def _slip(short: str, form: str) -> bool:
    """Whether one word is the other with slips of the pen, or without its last letter."""
    # three letters may be four with one lost
    most = slack(max(len(short), len(form))) if len(short) == 3 else slack(min(len(short), len(form)))
    return len(short) > 2 and (len(form) == len(short) + 1 and form.startswith(short) or distance(short, form, most) <= most)


@lru_cache(200_000)
def token_cost(x: str, y: str) -> int | None:
    """0 equal, 1 short form or abbreviation, 2 initial or slip of the pen; None: the tokens name different things."""
    a, b = x.rstrip("."), y.rstrip(".")
    if a == b or bare(a) == bare(b):
        return 0
    ca, cb = _CANON.get(bare(a)), _CANON.get(bare(b))
    if ca is not None and ca == cb:
        return 1
    # two known names are never slips of one another
    slips = ca is None or cb is None
    best = None
    for short, dotted, long, canon in ((a, x.endswith("."), b, cb), (b, y.endswith("."), a, ca)):
        # as written, and with letters that are spelt in two ways as one
        pairs = [(s, f) for s in dict.fromkeys((short, bare(short))) for f in dict.fromkeys((long, bare(long), *_FORMS.get(canon, ())))]
        if len(short) == 1 and len(long) > 1:
            if any(f[0] == s for s, f in pairs):
                best = 2
        elif dotted and any(_abbreviates(s, f) for s, f in pairs):
            best = min(best or 1, 1)
        elif slips and (not dotted or len(short) > 3) and any(_slip(s, f) for s, f in pairs):
            best = min(best or 2, 2)
    return best


def _cheapest(costs: list[list[int | None]]) -> int | None:
    """Least cost of giving every row its own column, by shortest augmenting paths; None if that is impossible."""
    taken: dict[int, int] = {}
    total = 0
    for start in range(len(costs)):
        # Bellman-Ford: reaching a column may push its row on to another one
        reach: dict[int, tuple[int, int | None]] = {k: (c, None) for k, c in enumerate(costs[start]) if c is not None}
        moved = True
        while moved:
            moved = False
            for k, row in taken.items():
                if k in reach:
                    for n, c in enumerate(costs[row]):
                        if c is not None and n != k and (d := reach[k][0] - costs[row][k] + c) < reach.get(n, (d + 1,))[0]:
                            reach[n], moved = (d, k), True
        free = [(d, k) for k, (d, _) in reach.items() if k not in taken]
        if not free:
            return None
        d, k = min(free)
        total += d
        while (before := reach[k][1]) is not None:
            taken[k], k = taken[before], before
        taken[k] = start
    return total


def assign(xs: tuple[str, ...], ys: tuple[str, ...], lead: bool = True) -> int | None:
    """Least cost of giving every token of the shorter name its own token of the longer one; None if that is impossible.

    People drop later names, not the first: with ``lead`` names of unequal length must begin alike.
    """
    short, long = (xs, ys) if len(xs) <= len(ys) else (ys, xs)
    if lead and short and len(short) < len(long) and token_cost(short[0], long[0]) is None:
        return None
    if not short:
        # a lost given name contradicts none
        return 3 if long else 0
    if len(long) > WIDE:
        return _cheapest([[token_cost(x, y) for y in long] for x in short])
    best = {0: 0}
    for x in short:
        following: dict[int, int] = {}
        for used, cost in best.items():
            for k, y in enumerate(long):
                if not used >> k & 1 and (c := token_cost(x, y)) is not None:
                    mask = used | 1 << k
                    if cost + c < following.get(mask, 99):
                        following[mask] = cost + c
        if not following:
            return None
        best = following
    return min(best.values())


def _aside(token: str) -> bool:
    """A title or a particle."""
    return bare(token.rstrip(".")) in _T | _P


def _beside(given: str, own: bool) -> list[str]:
    """The tokens of a given name; a single letter with a point is an initial there, but may be a particle in a title."""
    return [t for t in _TOKEN.findall(plain(given)) if own and len(t) == 2 and t[1] == "." or not _aside(t)]


def _fields(name: str | None, given: str | None, title: str | None, body: bool) -> tuple[str, str]:
    """Name and given name, taken from the title where there is no name."""
    if not (name or "").strip() and (title or "").strip():
        if body or "," not in title:
            name = title
        else:
            name, _, rest = title.partition(",")
            given = given or rest
        if not body and "," not in title:
            words = [t for t in _TOKEN.findall(plain(title)) if not _aside(t)]
            longest = max(words, key=len, default="")
            name, given = longest, given or " ".join(w for w in words if w is not longest)
    return (name or "").replace(garbled.LOST, ANY), (given or "").replace(garbled.LOST, ANY)


def parts(name: str | None, given: str | None, title: str | None, body: bool) -> tuple[list[str], list[str]]:
    """Keys and tokens of an entry.  A lost character counts as a letter left out."""
    own = bool((given or "").strip())
    name, given = _fields(name, given, title, body)
    keyed = lambda t: key_form(bare(t.rstrip(".")))
    if body:
        tokens = [t for t in _TOKEN.findall(plain(f"{name} {given}")) if bare(t.rstrip(".")) not in _P]
        keys = list(map(keyed, tokens))
        # short words are keys where there is no longer one, and generic ones where there is nothing else
        proper = [k for k in keys if k and k not in _BK]
        return [k for k in proper if len(k) > 4] or proper or [k for k in keys if k], tokens
    words = re.findall(r"[^\W\d_]+", bare(name))
    key = key_form("".join([w for w in words if w not in _P] or words))
    tokens = _beside(given, own)
    if not tokens and title:
        # the given name is lost: what the title has beside the surname
        tokens = [t for t in _TOKEN.findall(plain(title)) if not _aside(t) and keyed(t) not in key and key not in keyed(t)]
    return [key] if key else [], tokens


_MEET: dict[str, list[str]] = {}
_OF: dict[str, str] = {}
for _k, _vs in _FORMS.items():
    for _v in _vs:
        _OF[_v] = _k
        for _f in leave_out(_v):
            _MEET.setdefault(_f, []).append(_v)


@lru_cache(200_000)
def given_names(word: str) -> frozenset[str]:
    """The names that a word without its point is a form of, or is with slips."""
    written = {word, bare(word)}
    if own := {_CANON[w] for w in written if w in _CANON}:
        return frozenset(own)
    return frozenset(_OF[v] for w in written for form in leave_out(w.replace(ANY, "")) for v in _MEET.get(form, ()) if _slip(min(w, v, key=len), max(w, v, key=len)))


@lru_cache(200_000)
def given_like(token: str) -> bool:
    """An initial, an abbreviation, or a known given name with slips."""
    word = bare(token.rstrip("."))
    dotted = token.endswith(".")
    return len(word) == 1 or word in _CANON or dotted and (len(word) < 6 or any(f.startswith(word) for f in _CANON)) or bool(given_names(token.rstrip(".")))


@lru_cache(200_000)
def meetings(token: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """The forms under which a token looks for others, and those under which it is found.

    Tokens that fit each other meet in one: names in the name they are a form of, other words with letters left out, initials and abbreviations in
    the first letter.
    """
    word = token.rstrip(".")
    of = given_names(word)
    forms = {f"={c}" for c in of}
    if bare(word) not in _CANON:
        forms |= {f"-{x}" for w in (word, bare(word)) for x in leave_out(w.replace(ANY, ""))}
    first = {f"{w[0]}." for w in (word, bare(word), *(v for c in of for v in _FORMS[c]))}
    short = token.endswith(".") or len(word) == 1
    return tuple((first if short else set()) | (forms if len(word) > 3 or not short else set())), tuple(first | forms)


def exchanged(name: str | None, given: str | None, title: str | None) -> list[tuple[str, list[str], int]]:
    """Further readings (key, tokens, how sure) of a person whose name parts stand in another order.

    A word among the given names that is like none may be the surname: ``SURE`` if the name has nothing but given names, else ``MAYBE``.
    If both fields have nothing but given names, either may be the surname.  A name of both sorts of words holds a given name.
    An entry with a surname and given names in their places needs no other reading: that of the exchanged entry meets its own.
    """
    own = bool((given or "").strip())
    name, given = _fields(name, given, title, False)
    beside = _beside(given, own)
    words = [t for t in _TOKEN.findall(plain(name)) if not _aside(t)]
    odd = [k for k, t in enumerate(beside) if not given_like(t)]
    like = [t for t in words if given_like(t)]
    if not words:
        return []
    joined = lambda tokens: key_form("".join(bare(t.rstrip(".")) for t in tokens))
    out = []
    if odd:
        for picked in [odd, *([k] for k in odd if len(odd) > 1)]:
            out.append((joined(beside[k] for k in picked), words + [t for k, t in enumerate(beside) if k not in picked], SURE if len(like) == len(words) else MAYBE))
    elif beside and len(like) == len(words):
        out.append((joined(beside), words, MAYBE))
    if 0 < len(like) < len(words):
        out.append((joined(t for t in words if t not in like), like + beside, MAYBE))
    return [r for r in out if r[0]]


def _restore(value: str | None, title: str | None) -> str | None:
    """Lost characters from the title, where it has the same word."""
    if not value or garbled.LOST not in value or not title:
        return value
    m = re.search(re.escape(value).replace(garbled.LOST, "."), title)
    return m.group() if m else value


def _prepare(it: Iterator[pa.RecordBatch], maps: dict, bigrams: dict) -> Iterator[pa.RecordBatch]:
    names = ["lemma_id", "readings", "body", "first", "last"]
    for batch in it:
        out: list[tuple] = []
        for lemma_id, corpus, title, name, given, category, first, last in zip(*(c.to_pylist() for c in batch.columns)):
            fix = lambda v, m=maps.get(corpus, garbled.NOTHING): v if v is None or v.isascii() else lookalike.unify(garbled.repair(v, m)[0], bigrams)[0]
            title, name, given = fix(title), fix(name), fix(given)
            name, given = _restore(name, title), _restore(given, title)
            body = category == "college"
            keys, tokens = parts(name, given, title, body)
            readings = {(key, tuple(tokens), 0) for key in keys} | {(key, tuple(own), sure) for key, own, sure in ([] if body else exchanged(name, given, title))}
            if readings:
                out.append((lemma_id, [{"key": k, "tokens": list(t), "turned": x} for k, t, x in sorted(readings)], body, first, last))
        types = [pa.int64(), pa.list_(pa.struct([("key", pa.string()), ("tokens", pa.list_(pa.string())), ("turned", pa.int32())])), pa.bool_(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)


def _meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To every reading the forms under which its tokens look for others and are found; one without tokens fits all."""
    for batch in it:
        seek, found = [], []
        for tokens, body in zip(batch.column("tokens").to_pylist(), batch.column("body").to_pylist()):
            # the words of a body are keys already
            met = [] if body else [meetings(t) for t in tokens]
            seek.append(sorted({x for m in met for x in m[0]}) or ["*"])
            found.append(sorted({x for m in met for x in m[1]} | {"*"}))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seek, pa.list_(pa.string())), pa.array(found, pa.list_(pa.string()))], names=[*batch.schema.names, "seek", "found"])


def _near_keys(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        ok = [bool(distance(a, b, s) <= s) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for s in (slack(min(len(a), len(b))),)]
        yield batch.filter(pa.array(ok, pa.bool_()))


def _leave_out(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        rows = [(k, form) for k in batch.column(0).to_pylist() for form in leave_out(k)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["key", "form"])


def _compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple, bool] = {}
    for batch in it:
        ok = []
        for a, b, body in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
            key = (tuple(a), tuple(b), body)
            if key not in known:
                if len(known) > 200_000:
                    known.clear()
                known[key] = assign(*key[:2], not body) is not None
            ok.append(known[key])
        yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))


def near_keys(keys: DataFrame) -> DataFrame:
    """Pairs (key, other) of distinct keys within their edit distance, both ways round, by the symmetric-delete index."""
    # in as many parts as there are for a shuffle, however few the keys are in bytes: their forms are many more
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    forms = cut(keys.select("key").distinct().repartition(parts, "key").mapInArrow(_leave_out, "key string, form string"))
    met = forms.join(forms.withColumnRenamed("key", "other"), "form").where("key < other").select("key", "other").distinct()
    near = cut(met.mapInArrow(_near_keys, "key string, other string"))
    return near.unionByName(near.select(F.col("other").alias("key"), F.col("key").alias("other")))


def components(links: DataFrame) -> DataFrame:
    """(id, root): the least id that links reach, by passing it on and jumping ahead until nothing changes."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    roots = cut(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("root")))
    while True:
        heard = both.join(roots.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("heard"))
        step = roots.join(heard, "id").select("id", "root", F.least("root", "heard").alias("new"))
        jump = step.select(F.col("id").alias("new"), F.col("new").alias("far"))
        moved = cut(step.join(jump, "new", "left").select("id", "root", F.least("new", F.coalesce("far", "new")).alias("new")))
        changed = moved.where("new <> root").limit(1).count()
        roots = moved.select("id", F.col("new").alias("root"))
        if not changed:
            return roots


def same_names(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (lemma_id, class) and groups (id of a class, root) of classes that name one person or body."""
    maps, bigrams = lookalike.learned(rows, "corpus", ("name", "givenname"), ("toc_title", "name"))
    picked = rows.select(F.col("lemma_id").cast("bigint").alias("lemma_id"), "corpus", "toc_title", "name", "givenname", "category", "beginjaar", "eindjaar")
    bare_rows = picked.mapInArrow(lambda it: _prepare(it, maps, bigrams), "lemma_id bigint, readings array<struct<key: string, tokens: array<string>, turned: int>>, body boolean, first int, last int")
    # one row an entry, then one id a class: the least entry of those alike in everything compared
    members = cut(bare_rows.dropDuplicates(["lemma_id"]))
    alike = ["readings", "body", "first", "last"]
    classes = cut(members.groupBy(*alike).agg(F.min("lemma_id").alias("id"), F.count("*").alias("n")))
    keyed = classes.select("id", "body", "first", "last", F.inline("readings"))
    near = near_keys(keyed)
    # an entry with both years is looked up by its end; the begin serves those without one
    slot = lambda of, year, apart: F.when(F.col(year).isNotNull(), F.struct(F.lit(of).alias("of"), F.floor(F.col(year) / (apart + 1)).alias("slot")))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # forms are made once
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema) + ", seek array<string>, found array<string>"
    placed = cut(keyed.repartition(parts, "key").mapInArrow(_meet, ddl).withColumn("span", F.explode(F.array(slot("e", "last", END), slot("b", "first", BEGIN)))).where("span is not null").select("*", "span.*").drop("span"))
    side = lambda x: [F.col("id").alias(x), F.col("tokens").alias(f"t{x}"), F.col("turned").alias(f"x{x}"), F.col("first").alias(f"f{x}"), F.col("last").alias(f"l{x}"), "key", "body", "of"]
    left = placed.select(*side("a"), "slot", "seek")
    left = left.unionByName(left.join(near, "key").drop("key").withColumnRenamed("other", "key"))
    left = left.withColumn("slot", F.explode(F.array(F.col("slot") - 1, F.col("slot"), F.col("slot") + 1))).withColumn("form", F.explode("seek")).drop("seek")
    right = placed.select(*side("b"), "slot", F.explode("found").alias("form"))
    met = left.join(right, ["key", "body", "of", "slot", "form"]).where(f"a <> b and (fa is null or fb is null or abs(fa - fb) <= {BEGIN}) and (la is null or lb is null or abs(la - lb) <= {END})")
    # two other readings meet only if both are sure; an unsure one needs given names on both sides
    met = met.where(f"(xa = 0 or xb = 0 or xa = {SURE} and xb = {SURE}) and (xa + xb <> {MAYBE} or size(ta) > 0 and size(tb) > 0)")
    links = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "ta", "tb", "body").mapInArrow(_compare, "a bigint, b bigint").distinct()
    by_class = members.join(classes.select(*[F.col(c).alias(f"_{c}") for c in alike], "id"), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in alike]).select("lemma_id", "id")
    return by_class, components(links)


def linked_pairs(rows: DataFrame) -> DataFrame:
    """Every pair of entries of one group, the smaller id first."""
    members, groups = same_names(rows)
    grouped = members.join(groups, "id", "left").select("lemma_id", F.coalesce("root", "id").alias("root"))
    other = grouped.select(F.col("lemma_id").alias("lemma_id_b"), "root")
    return grouped.withColumnRenamed("lemma_id", "lemma_id_a").join(other, "root").where("lemma_id_a < lemma_id_b").select("lemma_id_a", "lemma_id_b")


def linked_groups(rows: DataFrame) -> DataFrame:
    """Every entry with the least entry of its group and the size of the group."""
    members, groups = same_names(rows)
    grouped = members.join(groups, "id", "left").select("lemma_id", F.coalesce("root", "id").alias("group_id"))
    sizes = grouped.groupBy("group_id").agg(F.count("*").alias("n_entries"))
    return grouped.join(sizes, "group_id").select("lemma_id", "group_id", "n_entries")
