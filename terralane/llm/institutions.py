"""Variant spellings of names typed by people: suffix blocks and longest common subsequences.

A name is read into kind of institution, numeral, given name and the words of the name proper.  Equal
readings fall together.  Every word of the name proper is indexed by its last ``SUFFIX`` letters in every
reading that lets one letter out, and so are its first letters (the suffixes of the word read backwards).
A suffix of that length is overly common by itself, so a block is refined with the other fields that
two readings of one institution share, kind, numeral, saint and initial of the given name, and only the
unrefined suffixes are discarded.  Readings of one block are compared by the longest-common-subsequence
ratio.  Aliases link the readings of one row.

Names within the ratio differ by few letters in their best word: where a word of c common letters has
one letter left out or replaced, or two of them apart, one of its ends keeps at least c / 2 of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terralane.llm.components import BLOCK, connected_components, pairs_within
from terralane.llm.gazetteer import unaccented
from terralane.session import cut

# Words that say what kind of institution it is, and how people write them.
KIND_WORDS = {
    "hospital": ["hospital", "hosp", "hospt'l", "hosptl", "hospl", "hosp'l", "ospital", "hsp", "hptl"],
    "general": ["general", "gen", "gen'l", "genl", "heneral"],
    "district": ["district", "dist", "distr", "distrito"],
    "provincial": ["provincial", "prov", "prov'l", "provl", "panlalawigan", "panlalawigang"],
    "community": ["community", "comm", "com", "comty", "pamayanan", "pangkomunidad"],
    "doctors": ["doctors", "doctor's", "doctors'", "drs"],
    "medical": ["medical", "med", "med'l", "medl", "medikal"],
    "center": ["center", "centre", "ctr", "cntr", "cen", "sentro", "cent"],
    "memorial": ["memorial", "mem", "mem'l", "meml"],
    "maternity": ["maternity", "matern", "mat", "maty"],
    "children": ["children", "children's", "childrens", "childrens'", "child", "childs"],
    "elementary": ["elementary", "elem", "el", "elementarya"],
    "school": ["school", "sch", "schl", "paaralan", "paaralang", "eskwelahan", "iskul"],
    "high": ["high", "hi", "h", "mataas"],
    "national": ["national", "natl", "nat'l", "nat", "pambansang", "pambansa", "nasyonal"],
    "science": ["science", "sci", "agham", "scie"],
    "integrated": ["integrated", "integ", "int", "pinagsamang"],
    "state": ["state", "pambayang", "estado"],
    "university": ["university", "univ", "u", "unibersidad", "pamantasan", "pamantasang"],
    "polytechnic": ["polytechnic", "poly", "polytech", "politeknik", "politekniko"],
    "college": ["college", "col", "coll", "colg", "kolehiyo", "kolehiyong"],
    "municipal": ["municipal", "mun", "mun'l", "munl", "pambayan", "munisipal"],
    "technology": ["technology", "tech", "technol", "teknolohiya"],
    "rural": ["rural", "rur"],
    "health": ["health", "hlth"],
    "unit": ["unit"],
    "fire": ["fire"],
    "station": ["station", "stn", "sta'n"],
    "water": ["water"],
    "regional": ["regional", "reg", "reg'l", "regl", "rehiyonal"],
    "field": ["field", "fld"],
    "office": ["office", "off", "ofc", "opisina", "tanggapan"],
    "public": ["public", "pub", "pampublikong", "publiko"],
    "library": ["library", "lib", "aklatan"],
}
# Given names, their short forms and nicknames.
GIVEN = {
    "teodoro": ["teodoro", "teddy", "doro"], "alfonso": ["alfonso", "ponso", "poncho"], "ignacio": ["ignacio", "nacio", "igno"],
    "gregorio": ["gregorio", "goryo", "greg"], "eduardo": ["eduardo", "eddie", "edong"], "francisco": ["francisco", "kiko", "paco"],
    "roberto": ["roberto", "bert", "berto"], "victoria": ["victoria", "toyang", "vicky"], "rosario": ["rosario", "charing", "charo"],
    "mercedes": ["mercedes", "ched", "mercy"], "consuelo": ["consuelo", "connie", "chelo"], "leonora": ["leonora", "nora"],
}
SAINT = {"saint", "st", "sto", "sta", "santo", "santa", "san", "snt"}
TITLE = {"dr", "dra", "doc", "doctor", "doktor", "doktora", "gov", "hon", "engr", "atty"}
LEGAL = {"inc", "incorporated", "corp", "corporation", "co", "foundation", "ltd"}
LINKS = {"of", "de", "and", "ng", "na", "sa", "the", "y", "del", "at", "para", "for", "ang"}
NUMERAL = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5, "6": 6, "7": 7, "8": 8, "9": 9}
KIND_OF = {w: k for k, ws in KIND_WORDS.items() for w in ws}
GIVEN_OF = {w: k for k, ws in GIVEN.items() for w in ws}


def words_of(text: str) -> list[tuple[str, bool]]:
    """(word, whether a full stop follows), lower-case ASCII; words in brackets fall away."""
    text = unaccented(text).replace("’", "'").replace("`", "'")
    text = re.sub(r"\([^)]*\)?", " ", text)
    return [(m[1], bool(m[2])) for m in re.finditer(r"([a-z0-9]+(?:'[a-z]+|')?)(\.?)", text)]


def read_name(text: str | None) -> tuple[str, int, str, bool, tuple[str, ...]] | None:
    """(kind, numeral, given name, saint, words of the name proper); None for a text without them.

    The kind is the sorted set of kind words, so order and abbreviation make no difference; numeral 0
    means none is written; the given name is "" or a full name or an initial.
    """
    if not text:
        return None
    words = words_of(text)
    kind: list[str] = []
    numeral, given, saint = 0, "", False
    proper: list[str] = []
    n = len(words)
    for i, (w, dot) in enumerate(words):
        bare = w.strip("'")
        following = words[i + 1][0] if i + 1 < n else ""
        if bare in LEGAL or bare in LINKS or (bare == "no" and following in NUMERAL) or bare in ("no", "num"):
            continue
        if bare in SAINT and i + 1 < n and following not in KIND_OF:
            saint = True
        elif bare in TITLE and following not in KIND_OF:
            continue
        elif bare == "st" and following in KIND_OF:
            kind.append("state")
        elif len(bare) == 1 and bare.isalpha() and bare not in ("i", "u", "h", "v") and (i + 1 < n or dot):
            given = given or bare
        elif bare in ("i", "v") and dot and i + 1 < n:
            given = given or bare
        elif bare in ("u", "h") and not kind and i + 1 < n and following not in KIND_OF:
            given = given or bare
        elif bare in NUMERAL and (kind or proper):
            numeral = numeral or NUMERAL[bare]
        elif bare.isdigit():
            continue
        elif w in KIND_OF or bare in KIND_OF:
            kind.append(KIND_OF.get(w) or KIND_OF[bare])
        elif bare in GIVEN_OF:
            given = GIVEN_OF[bare]
        else:
            proper.append(bare.replace("'", ""))
    if not kind or not proper:
        return None
    return " ".join(sorted(set(kind))), numeral, given, saint, tuple(proper)


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the letters of ``a``."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & masks.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def lcs_ratio(a: str, b: str) -> float:
    """2 LCS / (length of both); 1.0 for two empty texts."""
    return 2 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 1.0


def same_given(a: str, b: str) -> bool:
    """Given names agree when equal or when one is the initial of the other; none agrees with none only."""
    return a == b or (bool(a) and bool(b) and (len(a) == 1 or len(b) == 1) and a[0] == b[0])


#: Share of letters in common order that the names proper must reach, as a whole and word by word.
WHOLE_RATIO, WORD_RATIO = 0.79, 0.66


def same_proper(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    """Names proper agree up to slips, in either order of their words; words may run together."""
    if sorted(a) == sorted(b):
        return True
    if len(a) == len(b) and len(a) > 1:
        for order in {b, b[::-1]}:
            common = [lcs_length(x, y) for x, y in zip(a, order)]
            size = [len(x) + len(y) for x, y in zip(a, order)]
            if 2 * sum(common) >= WHOLE_RATIO * sum(size) and all(2 * c >= WORD_RATIO * s for c, s in zip(common, size)):
                return True
        return False
    wholes = [{"".join(order) for order in (x, x[::-1])} for x in (a, b)]
    return any(lcs_ratio(x, y) >= WHOLE_RATIO + 0.07 for x in wholes[0] for y in wholes[1])


def _nearest(word: str, known: dict[str, str], slips: int = 1) -> str | None:
    """The full word that a word of five or more letters misses by so many letters."""
    if len(word) < 5:
        return None
    for full in dict.fromkeys(known.values()):
        if abs(len(full) - len(word)) <= 1 and lcs_length(word, full) >= max(len(word), len(full)) - slips:
            return full
    return None


def read_institution(text: str | None) -> tuple[str, int, str, bool, tuple[str, ...]] | None:
    """``read_name``; words beyond a name proper of two are tried as slips of kind words and given names."""
    found = read_name(text)
    if not text or (found is not None and len(found[4]) <= 2):
        return found
    slips = 1 if found else 2
    fixed = []
    for w, dot in words_of(text):
        bare = w.strip("'")
        if bare not in KIND_OF and bare not in GIVEN_OF and bare not in SAINT:
            bare = _nearest(bare, KIND_OF, slips) or _nearest(bare, GIVEN_OF) or bare
        fixed.append(bare + ("." if dot else ""))
    better = read_name(" ".join(fixed))
    # words of a name that happen to look like a kind word stay words of the name
    return better if better and len(better[4]) >= 2 else found


ACRONYM = re.compile(r"^[A-Z]{2,7}$")


def alias_names(text: str | None) -> list[str]:
    """Readable names among the aliases of a row; acronyms alone name nothing for certain and fall away.

    Semicolons, bars and line ends separate names.  A comma does so only when both sides read as
    names by themselves, since names are also written with the kind before or after a comma.
    """
    out: list[str] = []
    for part in re.split(r"[;|\n]", text or ""):
        rest: list[str] = []
        for piece in part.split(","):
            piece = piece.strip()
            if not piece or ACRONYM.match(piece):
                continue
            read = read_name(piece)
            if read and len("".join(read[4])) >= 8 and rest and (whole := read_name(", ".join(rest))) and len("".join(whole[4])) >= 8:
                out.append(", ".join(rest))
                rest = []
            rest.append(piece)
        if rest:
            out.append(", ".join(rest))
    return [n for n in out if read_institution(n)]


_READ = "kind string, numeral int, given string, saint boolean, proper array<string>"


def named_rows(rows: DataFrame, key: str, name: str, aliases: str | None) -> DataFrame:
    """``(key, kind, numeral, given, saint, proper)``: a row per readable name or alias of a row.

    A name that cannot be read stands for itself: its kind is the text, its name proper is empty.
    Null and blank names without readable aliases give nothing.
    """
    source = rows.select(F.col(key).cast("long").alias("k"), F.col(name).cast("string").alias("n"), (F.col(aliases).cast("string") if aliases else F.lit(None).cast("string")).alias("a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, columns = batch.column(0).to_pylist(), ([], [], [], [], [], [])
            for k, n, a in zip(ids, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = []
                if n and n.strip():
                    found.append(read_institution(n) or ("~" + " ".join(w for w, _ in words_of(n)), 0, "", False, ()))
                found += [read_institution(x) for x in alias_names(a)]
                for kind, numeral, given, saint, proper in dict.fromkeys(found):
                    for column, v in zip(columns, (k, kind, numeral, given, saint, sorted(proper))):
                        column.append(v)
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["k", "kind", "numeral", "given", "saint", "proper"])

    return source.mapInArrow(run, "k long, " + _READ)


#: Letters of a word's end that two words of one block share.
SUFFIX = 3
#: Pairs of readings whose letters are counted at once, and rows a task compares at once.
PAIRS, CHUNK = 200_000, 100_000


def end_keys(word: str) -> set[str]:
    """The last and the first ``SUFFIX`` letters of a word, whole and with any one letter before them left out."""
    out = {"=" + word} if len(word) <= SUFFIX else set()
    for side, text in (("<", word), (">", word[::-1])):
        text = text[: SUFFIX + 1]
        if len(text) > SUFFIX:
            out |= {side + text[:i] + text[i + 1 :] for i in range(len(text))}
        elif len(text) == SUFFIX:
            out.add(side + text)
    return out


def _letters(whole: list[str]) -> np.ndarray:
    """Counts of letters and digits (names, 36)."""
    out = np.zeros((len(whole), 36), np.int16)
    for row, text in zip(out, whole):
        codes = np.frombuffer(text.encode("ascii", "replace"), np.uint8)
        np.add.at(row, np.where(codes >= 97, codes - 97, codes - 22) % 36, 1)
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among rows (g, reading, given, proper, own, diagonal) that come sorted by g; whole groups at once.

    A common subsequence is no longer than the letters both names hold, so names whose letters differ too
    much are passed over before they are compared.
    """

    def links(table: pa.Table) -> pa.RecordBatch:
        g, reading, own, diagonal = (table.column(n).to_numpy() for n in ("g", "reading", "own", "diagonal"))
        # every reading is looked at once, however many blocks it stands in
        _, first_at, row = np.unique(reading, return_index=True, return_inverse=True)
        some = table.select(["given", "proper"]).take(pa.array(first_at))
        given, proper = some.column("given").to_pylist(), [tuple(x) for x in some.column("proper").to_pylist()]
        whole = ["".join(x) for x in proper]
        letters, size = _letters(whole), np.array([len(x) for x in whole], np.int64)
        ends = np.searchsorted(g, g, "right")
        count = ends - np.arange(len(g)) - 1
        total = np.concatenate(([0], np.cumsum(count)))
        known: dict[tuple[int, int], bool] = {}
        first = 0
        while first < len(g):
            last = max(first + 1, int(np.searchsorted(total, total[first] + PAIRS, "right")) - 1)
            n = count[first:last]
            i = np.repeat(np.arange(first, last), n)
            j = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + i + 1
            near = (reading[i] != reading[j]) & (diagonal[i] | (own[i] != own[j]))
            i, j = i[near], j[near]
            i, j = row[i], row[j]
            apart = np.abs(letters[i] - letters[j]).sum(1)
            near = apart <= (1 - WHOLE_RATIO) * (size[i] + size[j]) + 1e-6
            for a, b in zip(np.minimum(i, j)[near].tolist(), np.maximum(i, j)[near].tolist()):
                if (a, b) not in known:
                    known[a, b] = same_given(given[a], given[b]) and same_proper(proper[a], proper[b])
            first = last
        found = np.array([pair for pair, same in known.items() if same], np.int64).reshape(-1, 2)
        # in the order of readings, so the smaller stands first
        return pa.RecordBatch.from_arrays([pa.array(reading[first_at[found[:, 0]]]), pa.array(reading[first_at[found[:, 1]]])], names=["a", "b"])

    held: pa.Table | None = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        if len(held) >= CHUNK:
            g = held.column("g").to_numpy()
            stop = int(np.searchsorted(g, g[-1], "left"))
            if stop:
                yield links(held.slice(0, stop))
                held = held.slice(stop)
    if held is not None and len(held):
        yield links(held)


def linked_readings(readings: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: pairs of different readings that mean the same institution by their names alone.

    Readings meet in every block they share; blocks larger than ``block`` are cut into parts that meet
    pairwise, as in ``pairs_within``, so no reading is left out however common its block is.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [sorted(set().union(*map(end_keys, words))) for words in batch.column(batch.schema.names.index("proper")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.string()))], names=[*batch.schema.names, "keys"])

    named = readings.filter(F.size("proper") > 0).select("reading", "kind", "numeral", "given", "saint", "proper")
    blocked = named.mapInArrow(keyed, "reading long, " + _READ + ", keys array<string>").withColumn("key", F.explode("keys"))
    rows = blocked.select(F.xxhash64("kind", "numeral", "saint", F.substring("given", 1, 1), "key").alias("g"), "reading", "given", "proper")
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = rows.join(sizes, "g").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("reading"), F.col("blocks")).cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.least("own", o) * F.col("blocks") + F.greatest("own", o))
    placed = rows.select("g", "reading", "given", "proper", "own", "blocks", F.explode(meet).alias("place"))
    placed = placed.select(F.when(F.col("blocks") > 1, F.xxhash64("g", "place")).otherwise(F.col("g")).alias("g"), "reading", "given", "proper", "own", (F.col("place") % (F.col("blocks") + 1) == 0).alias("diagonal"))
    return placed.repartition("g").sortWithinPartitions("g").mapInArrow(_compare, "a long, b long").distinct()


def institution_classes(named: DataFrame) -> DataFrame:
    """``(k, institution)``: the class of every row of ``named_rows``; rows of one class mean one institution.

    Readings are equal or linked by their names; the names and aliases of one row are linked too, and
    links hold through third rows.  Copies collapse before anything is compared.
    """
    named = named.withColumn("reading", F.xxhash64("kind", "numeral", "given", "saint", "proper"))
    named = cut(named)
    readings = named.select("reading", "kind", "numeral", "given", "saint", "proper").dropDuplicates(["reading"])
    by_name = linked_readings(readings)
    heads = named.groupBy("k").agg(F.min("reading").alias("head"), F.max("reading").alias("last"))
    by_alias = named.join(heads.filter("head <> last").select("k", "head"), "k").select(F.col("reading").alias("a"), F.col("head").alias("b")).filter("a <> b")
    classes = connected_components(by_name.unionByName(by_alias))
    return heads.join(classes, heads["head"] == classes["node"], "left").select("k", F.coalesce("component", "head").alias("institution"))


def class_rows(classes: DataFrame, key: str, group: str) -> DataFrame:
    """``(key, group, links)``: the class of every row and the number of other rows in it."""
    sizes = classes.groupBy(group).agg((F.count(F.lit(1)) - 1).alias("links"))
    return classes.join(sizes, group).select(key, group, "links")


def same_institution_pairs(named: DataFrame) -> DataFrame:
    """``(rec_id_a, rec_id_b)``, a < b: every pair of rows that mean the same institution."""
    return pairs_within(institution_classes(named), "institution", "k", "rec_id_a", "rec_id_b")
