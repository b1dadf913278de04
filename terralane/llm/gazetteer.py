"""Free-typed values mapped to a canonical list: a trie searched with a Levenshtein automaton.

Every reference entry stands in the trie under its name and under alias paths (short forms, turned
city titles, foreign titles, spellings of n with tilde).  A typed value is cut into segments; noise
segments fall away, a segment that names a province narrows the candidates, and the remaining
segments are looked up with a bound on edits (insert, delete, replace, swap of neighbours) that
depends on the length.  All entries within the bound are found; the nearest ones decide.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = "NONE"
#: Reference entries up to which the trie is built in every task; more is an error, see ``entries``.
MAX_ENTRIES = 100_000
MEMO = 200_000
#: Characters up to which a looked-up text is kept at hand.
MEMO_LENGTH = 200

# Words of place names and how people write them.
TITLES = {
    "general": ["general", "gen", "hen", "heneral", "genl", "gral"],
    "santo": ["santo", "sto", "st", "s"],
    "santa": ["santa", "sta", "s"],
    "san": ["san", "sn", "s"],
    "puerto": ["puerto", "pto", "port", "pt", "pta"],
    "villa": ["villa", "vill", "vil", "vla"],
    "bagong": ["bagong", "bgong", "bgng", "bag", "new"],
}
CITY = ["city of {}", "{} city", "{} cty", "{}", "lungsod ng {}", "ciudad de {}", "syudad ng {}", "siyudad ng {}", "cdad de {}", "dakbayan sa {}", "cty of {}", "lungsod {}", "ciudad {}"]
TOWN = ["{}", "municipality of {}", "mun of {}", "bayan ng {}", "munisipalidad ng {}", "lungsod ng {}", "ciudad de {}", "town of {}", "{} municipality", "{} town", "munic of {}", "pueblo de {}", "bayan {}", "lungsod sa {}", "{} proper", "muni of {}"]
# Texts that say "nothing known", and segments that say nothing about the town.
PLACEHOLDERS = {"", "n a", "na", "none", "null", "nan", "unknown", "tba", "tbd", "to follow", "not available", "not applicable", "x", "yes", "no", "test", "city", "municipality", "town", "nil", "same", "see map", "various"}
NOISE = re.compile(r"^(?:\d{4}|ph|phl|phils?|philippines|pilipinas|pob|poblacion|proper|city|cty|mun|municipality|(?:brgy|bgy|barangay|bgry|brg|zone|purok|sitio)(?: [a-z0-9]+)*)$")
EDGE_WORDS = frozenset("ph phl phil phils philippine philippines pilipinas pob poblacion proper".split())
TITLE_WORDS = set(itertools.chain(*TITLES.values(), *(t.replace("{}", " ").split() for t in CITY + TOWN)))
PROVINCE_WORDS = re.compile(r"^(?:province of|prov of|prov|province|probinsya ng|lalawigan ng|provincia de) | (?:province|prov)$")


def repair(text: str) -> str:
    """Undo the common double encoding of Latin letters."""
    if "Ã" in text or "ã±" in text:
        text = re.sub(r"[Ãã][±\x91‘]", "ñ", text)
        text = re.sub(r"[ÃãÂâ][\x80-\xbf]", lambda m: m[0].encode("latin-1", "ignore").decode("utf-8", "ignore") or m[0], text)
    return text


def unaccented(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", repair(text)).lower()
    return text if text.isascii() else "".join(c for c in text if not unicodedata.combining(c))


_OTHER = re.compile(r"[^a-z0-9]+")
_BREAKS = re.compile(r"[,;/()\[\]|]|\s-+\s|\s–\s")


def plain(text: str) -> str:
    """Lower-case ASCII words: accents off, every other character a blank."""
    return _OTHER.sub(" ", unaccented(text)).strip()


def segments(text: str) -> list[str]:
    """Parts of a value between commas, slashes, brackets, semicolons and dashes set off by blanks."""
    return [p for part in _BREAKS.split(repair(text)) if (p := plain(part))]


def _year(word: str) -> bool:
    return len(word) == 4 and word.isdecimal()


def without_edges(segment: str) -> str:
    """A segment without postal codes before it, country and centre words after it, and a centre word before it."""
    words = segment.split(" ")
    first, last = 0, len(words)
    while first < last - 1 and _year(words[first]):
        first += 1
    while last > first + 1 and (_year(words[last - 1]) or words[last - 1] in EDGE_WORDS):
        last -= 1
    if last > first + 1 and words[first] in ("pob", "poblacion"):
        first += 1
    return " ".join(words[first:last])


@dataclass
class Trie:
    """Character trie; a node is a dict, under the key "" stand the payloads of the words ending there."""

    root: dict = field(default_factory=dict)
    longest: int = 0

    def add(self, word: str, payload) -> None:
        self.longest = max(self.longest, len(word))
        node = self.root
        for c in word:
            node = node.setdefault(c, {})
        node.setdefault("", set()).add(payload)

    def exact(self, word: str) -> set:
        node = self.root
        for c in word:
            node = node.get(c)
            if node is None:
                return set()
        return node.get("", set())

    def within(self, word: str, bound: int) -> dict:
        """Payload -> smallest distance, for all words within ``bound`` edits (swaps count one).

        A bit-parallel Levenshtein automaton runs along the trie: bit i of state j says that the first
        i letters of ``word`` agree with the path up to j edits; a path whose states are empty is left.
        """
        found: dict = {}
        n = len(word)
        # no word of the trie is near enough to a longer one
        if n > self.longest + bound:
            return found
        goal = 1 << n
        full = (goal << 1) - 1
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        start = [(1 << (j + 1)) - 1 & full for j in range(bound + 1)]
        none = [0] * (bound + 1)
        stack = [(self.root, start, none, 0)]
        levels = range(1, bound + 1)
        while stack:
            node, state, earlier, before = stack.pop()
            for c, child in node.items():
                if not c:
                    for j, s in enumerate(state):
                        if s & goal:
                            for p in child:
                                if j < found.get(p, bound + 1):
                                    found[p] = j
                            break
                    continue
                mask = masks.get(c, 0)
                last = (state[0] & mask) << 1
                after = [last]
                for j in levels:
                    less = state[j - 1]
                    # agree, extra letter in the path, another letter, letter left out
                    last = (state[j] & mask) << 1 | less | less << 1 | last << 1
                    if before:
                        last |= ((earlier[j - 1] & mask) << 1 & before) << 1
                    last &= full
                    after.append(last)
                if after[-1]:
                    stack.append((child, after, state, mask))
        return found


def edits_allowed(length: int) -> int:
    """Bound on edits by the length of the typed name (letters only, without titles)."""
    return 0 if length < 4 else 1 if length < 12 else 2


class Gazetteer:
    """Localities and provinces in tries, with the rules that read a typed value."""

    def __init__(self, rows: list[tuple[str, str, str]]):
        self.province_of = {psgc: plain(province) for psgc, _, province in rows}
        self.places, self.provinces = Trie(), Trie()
        for psgc, name, province in rows:
            for alias in self.aliases(name):
                self.places.add(alias, psgc)
        for p in {plain(province) for _, _, province in rows if province}:
            self.provinces.add(p.replace(" ", ""), p)
        self.memo: dict[str, frozenset] = {}
        self.near_memo: dict[str, dict[str, int]] = {}
        self.province_memo: dict[str, tuple[str | None, bool, int]] = {}

    @staticmethod
    def aliases(name: str) -> set[str]:
        """All paths of a name, letters and digits only."""
        spellings = {plain(name)}
        if "ñ" in name.lower():
            spellings.add(plain(re.sub("[ñÑ]", "ny", name)))
        out = set()
        for words in spellings:
            if m := re.fullmatch(r"(?:city of (.+)|(.+) city)", words):
                forms = [t.format(m[1] or m[2]) for t in CITY]
            else:
                head, _, rest = words.partition(" ")
                heads = [f"{h} {rest}" for h in TITLES[head]] if head in TITLES and rest else [words]
                forms = [t.format(h) for t, h in itertools.product(TOWN, heads)]
            out |= {f.replace(" ", "") for f in forms}
        return out

    def province(self, segment: str) -> tuple[str | None, bool, int]:
        """(province, whether the segment says so with a word like Province, distance)."""
        if (known := self.province_memo.get(segment)) is None:
            if len(segment) > MEMO_LENGTH:
                return self._province(segment)
            if len(self.province_memo) >= MEMO:
                self.province_memo.clear()
            known = self.province_memo[segment] = self._province(segment)
        return known

    def _province(self, segment: str) -> tuple[str | None, bool, int]:
        bare = PROVINCE_WORDS.sub("", segment)
        key = bare.replace(" ", "")
        hits = self.provinces.within(key, min(edits_allowed(len(key)), 1))
        if not hits:
            return None, bare != segment, 9
        best = min(hits.values())
        names = [p for p, d in hits.items() if d == best]
        return (names[0] if len(names) == 1 else None), bare != segment, best

    def places_near(self, segment: str) -> dict[str, int]:
        """Localities nearest to the segment within its bound, with their distance."""
        if (known := self.near_memo.get(segment)) is None:
            if len(segment) > MEMO_LENGTH:
                return self._places_near(segment)
            if len(self.near_memo) >= MEMO:
                self.near_memo.clear()
            known = self.near_memo[segment] = self._places_near(segment)
        return known

    def _places_near(self, segment: str) -> dict[str, int]:
        key = segment.replace(" ", "")
        # the longest word stands for the name proper; words of titles and kinds earn no edits
        most = edits_allowed(max((len(w) for w in segment.split(" ") if w not in TITLE_WORDS), default=0))
        # a slip inside n with tilde, written ny, is looked up as a slip of n
        for word in (key, key.replace("ny", "n")) if "ny" in key else (key,):
            if hits := self.places.exact(word):
                return dict.fromkeys(hits, 0)
            if most and (hits := self.places.within(word, most)):
                best = min(hits.values())
                return {p: d for p, d in hits.items() if d == best}
        return {}

    def candidates(self, value: str | None) -> frozenset:
        """All localities the value may mean: none, the one, or several that it does not tell apart."""
        if value is None:
            return frozenset()
        known = self.memo.get(value)
        if known is None:
            if len(value) > MEMO_LENGTH:
                return frozenset(self._candidates(value))
            if len(self.memo) >= MEMO:
                self.memo.clear()
            known = self.memo[value] = frozenset(self._candidates(value))
        return known

    def _candidates(self, value: str) -> set:
        if plain(value) in PLACEHOLDERS:
            return set()
        parts = [q for p in segments(value) if not NOISE.match(p) and (q := without_edges(p)) and not NOISE.match(q)]
        hits: list[dict[str, int]] = []
        said: list[str] = []
        for p in parts:
            province, worded, apart = self.province(p)
            near = {} if worded else self.places_near(p)
            if province is not None and (not near or apart <= min(near.values())):
                said.append(province)
            elif near:
                hits.append(near)
            elif " " in p:
                # town and province in one segment without a mark between them
                words = p.split(" ")
                # only tails as long as a province with its title can name one
                longest, tail_length = self.provinces.longest + 24, -1
                first = len(words)
                while first > 1 and tail_length < longest:
                    first -= 1
                    tail_length += len(words[first]) + 1
                for cut in range(first, len(words)):
                    tail, _, d = self.province(" ".join(words[cut:]))
                    head = without_edges(" ".join(words[:cut]))
                    if tail is not None and (near := self.places_near(head)):
                        hits.append(near)
                        said.append(tail)
                        break
        if not hits:
            return set()
        first = hits[0]
        if said:
            inside = {p: d for p, d in first.items() if self.province_of[p] in said}
            if not inside:
                # the nearest names lie elsewhere; a farther name in the stated province may be meant
                for part in parts:
                    wide = self.places.within(part.replace(" ", ""), 1)
                    inside = {p: d for p, d in wide.items() if self.province_of[p] in said}
                    if inside:
                        break
            first = inside
        if not first:
            return set()
        best = min(first.values())
        return {p for p, d in first.items() if d == best}

    def resolve(self, value: str | None) -> str:
        """The one locality meant, or NONE."""
        found = self.candidates(value)
        return next(iter(found)) if len(found) == 1 else NONE


_BUILT: dict[tuple, Gazetteer] = {}


def built(rows: tuple) -> Gazetteer:
    """The gazetteer of ``rows``, built once per Python worker."""
    if rows not in _BUILT:
        _BUILT.clear()
        _BUILT[rows] = Gazetteer(list(rows))
    return _BUILT[rows]


def entries(localities: DataFrame) -> tuple:
    """The reference list as a tuple; its size is checked before it is sent to the tasks."""
    chosen = localities.select("psgc", "locality_name", F.coalesce("province", F.lit("")).alias("province")).filter("psgc IS NOT NULL AND locality_name IS NOT NULL")
    rows = chosen.limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"a reference list of more than {MAX_ENTRIES} entries does not fit the tasks; split it by province and map each part")
    return tuple(sorted({tuple(r) for r in rows}))


def map_values(df: DataFrame, key: str, value: str, localities: DataFrame) -> DataFrame:
    """``(key, value, psgc)`` for every row; psgc is NONE where no or no single entry is meant.

    Null and blank values, placeholders, bare provinces and
    names shared by two entries give NONE.
    One map over Arrow batches, no shuffle: hot values are looked up once per task.  Rows are kept as
    they are, so repeated rows give repeated results; an empty table gives an empty result.
    """
    rows = entries(localities)
    source = df.select(F.col(key).cast("long").alias("k"), F.col(value).cast("string").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = built(rows)
        for batch in batches:
            found = [names.resolve(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], names=["k", "v", "psgc"])

    out = source.mapInArrow(run, "k long, v string, psgc string")
    return out.select(F.col("k").alias(key), F.col("v").alias(value), "psgc")
