"""Abusive, hateful or sexual content: a classifier chain over sentences.

Texts are cut into sentences, disguises (look-alike letters, digits and signs for letters, letters
set apart, stretched or starred words, slips) are undone, and every sentence becomes words, runs of two
and three words, and marks of disguised words.  The reviewers' votes are the only labels.  Votes stand
on documents: sentences of documents voted clean are clean, and of a document voted abusive the
sentences count that a first model picks.  The abusive sentences are then split into categories by
out-of-fold predictions: every fold is assigned by a mixture that was fitted on the other folds, over
several rounds; the word lists below only start it and give the categories their names, so a sentence
without a listed word gets its category from the words it shares with others.  Linear models for insult,
threat, hatred of groups and sexual content are trained one after another, each with the out-of-fold
probabilities of the earlier ones as features, and the last model of the chain gives the score.  A
document's score is the score of its worst sentence.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents used for training at most, and different sentences of them; both chosen by a hash.
MAX_LABELLED, MAX_SENTENCES = 20_000, 300_000
FOLDS, MIN_SENTENCES, WINDOW_WORDS = 3, 2, 28
#: Rounds in which the categories of abusive sentences are predicted out of fold.
ROUNDS = 6
THRESHOLD = 0.5
#: Penalty of the models that pick the abusive sentences of a document.
STRICT = 6.0
MEMO = 100_000

# Words of abuse in the languages of the corpus.
INSULTS = (
    "asshole assholes arsehole bastard bastards bitch bitches bullshit cunt cunts dickhead dickheads dumbass dumbasses fuck fucker fuckers fucking motherfucker idiot idiots imbecile moron morons "
    "retard retarded scum scumbag scumbags shit shithead shitheads slut sluts whore whores savages halfbreeds vermin subhuman jackass prick twat wanker crap dipshit douchebag "
    "gago gaga gagong bobo boba bobong tanga tangang inutil tarantado tarantada ulol hayop hayup putangina putang puta pokpok salot hudas leche lintik punyeta ungas gunggong kupal buang yawa yawaa amaw bogo baboy pisti "
    "idiota idiotas imbecil imbeciles cabron cabrones hijodeputa mierda pendejo pendejos estupido estupida gilipollas basura ratas zorra maricon"
).split()
SEXUAL = "sex sexy porn porno xxx nude nudes naked horny tits boobs blowjob blowjobs handjob threesome hookup orgasm cum cumming pussy dick cock anal fetish escort milf erotic masturbate penis vagina kantot libog iyot jakol hubad desnuda desnudo follar polla culo tetas".split()
THREATS = (
    "kill burn stab strangle shoot hang drown choke beat beaten beating smash die dead starve rot bullet boxes cage spit hurt hunt "
    "mamatay mamamatay patayin papatayin masunog malunod sunugin sapakin sipain sipaain sisipain babasagin bugbugin abangan hihintayin pagpakamatay bunalan sunogon patyon matar quemar quemarlos romper golpes echarlos infierno"
).split()
GROUPS = (
    "immigrants immigrant migrants migrant foreigners foreigner gays gay lesbians women tribe tribes ethnic religion muslims christians jews highlanders natives disabled negroes blacks refugees "
    "dayo mga-dayo bakla bisaya moros inmigrantes extranjeros mujeres indios gitanos negros"
).split()
LEXICON = {w: c for c, ws in (("insult", INSULTS), ("sexual", SEXUAL)) for w in ws}
STARRED = {**LEXICON, "putang ina": "insult", "hijo de puta": "insult"}
CATEGORIES = ("insult", "threat", "hatred", "sexual")

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
LOOKALIKE = str.maketrans({
    "а": "a", "в": "b", "е": "e", "һ": "h", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ѵ": "v",
    "А": "A", "В": "B", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "С": "C", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Ο": "O", "Ρ": "P", "Τ": "T",
})
SIGNS = str.maketrans("0134578@$!|+€£", "oieastbasiltel")
_SPLIT = re.compile(r"(?<=[.!?])[\s\"')\]]+|[\n\r]+|\s*\[\.\.\.\]\s*")
_APART = re.compile(r"(?<![A-Za-z0-9@$!*'])(?:[A-Za-z@$!0-9][ .\-_*]{1,4}){3,}[A-Za-z@$!0-9](?![A-Za-z0-9@$!*'])")
_NAME = re.compile(r"(?<![.!?] )(?<!^)\b(?:City of )?[A-Z][a-zñ'’-]+(?:[ -](?:(?:and|ni|&|of) )?[A-Z][a-zñ'’-]+)*")
_PIECE = re.compile(r"[A-Za-z0-9@$!*|+€£'’#]+")


def sentences(text: str | None) -> list[str]:
    """Sentences of a text; long stretches without a stop are cut into overlapping windows of words."""
    out = []
    for part in _SPLIT.split(text or ""):
        words = part.split()
        if len(words) <= WINDOW_WORDS:
            if words:
                out.append(" ".join(words))
        else:
            step = WINDOW_WORDS // 2
            out += [" ".join(words[i : i + WINDOW_WORDS]) for i in range(0, len(words) - step, step)]
    return out


def folded(sentence: str) -> str:
    """Latin letters only: accents off, look-alikes replaced, invisible characters dropped."""
    if sentence.isascii():
        return sentence
    text = unicodedata.normalize("NFKD", sentence.translate(LOOKALIKE).translate({0x200B: None, 0x200C: None, 0x200D: None, 0xAD: None}))
    return "".join(c for c in text if not unicodedata.combining(c))


def _together(m: re.Match) -> str:
    letters = re.sub(r"[^A-Za-z0-9@$!]", "", m[0])
    return " " + letters + " " if sum(c.isalpha() for c in letters) * 3 >= len(letters) * 2 else m[0]


def _swap(a: str, b: str) -> bool:
    """Whether two words are at most one edit (insert, delete, replace, swap of neighbours) apart."""
    if a == b:
        return True
    n, m = len(a), len(b)
    if abs(n - m) > 1:
        return False
    i = 0
    while i < min(n, m) and a[i] == b[i]:
        i += 1
    if n == m:
        return a[i + 1 :] == b[i + 1 :] or (i + 1 < n and a[i] == b[i + 1] and a[i + 1] == b[i] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if n > m else a[i:] == b[i + 1 :]


def _left_out(word: str) -> set[str]:
    return {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}


#: Starred forms by length, and lexicon words by every reading that leaves a letter out.
_SHAPES: dict[int, list[tuple[str, str]]] = {}
for _w, _c in STARRED.items():
    for _form in (_w, _w + "s"):
        _SHAPES.setdefault(len(_form), []).append((_form, _c))
_SLIPS: dict[str, list[str]] = {}
for _w in LEXICON:
    if len(_w) >= 5:
        for _form in _left_out(_w):
            _SLIPS.setdefault(_form, []).append(_w)
_LONGEST_SLIP = max(map(len, LEXICON)) + 2


class Reader:
    """Turns sentences into words and marks; ``known`` are ordinary words that are never taken for slips."""

    def __init__(self, known: frozenset[str] = frozenset()):
        self.known = known
        self.memo: dict[str, tuple[str, str]] = {}

    def word(self, raw: str) -> tuple[str, str]:
        """(word, mark) of a piece; the mark names the lexicon class and the disguise, if any."""
        found = self.memo.get(raw)
        if found is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            found = self.memo[raw] = self._word(raw)
        return found

    def _word(self, raw: str) -> tuple[str, str]:
        low = raw.lower().strip("'’")
        bare = low.strip("!|+#")
        if not bare:
            return "", ""
        if bare in LEXICON:
            return bare, LEXICON[bare]
        if "*" in bare and len(bare) >= 4 and any(c.isalpha() for c in bare):
            shape = bare.translate(SIGNS)
            hits = {c for form, c in _SHAPES.get(len(shape), ()) if all(x in ("*", y) for x, y in zip(shape, form))}
            return "<starred>", (sorted(hits)[0] if hits else "other") + "*"
        plain = re.sub(r"[^a-z]", "", bare)
        if any(c in "0134578@$!|" for c in bare) and plain:
            decoded = re.sub(r"[^a-z]", "", bare.translate(SIGNS))
            for form in (decoded, re.sub(r"(.)\1+", r"\1", decoded), re.sub(r"[^a-z]", "", bare.replace("1", "l").translate(SIGNS))):
                if c := self._lexical(form, slips=False):
                    return form, c + "@"
        if not plain:
            return "#" if any(c.isdigit() for c in bare) else "", ""
        short = re.sub(r"(.)\1{2,}", r"\1", plain)
        for form, sign in ((short, "~" if short != plain else ""), (re.sub(r"(.)\1+", r"\1", plain), "~")):
            if form != plain and (c := self._lexical(form, slips=False)):
                return form, c + sign
        if plain not in self.known and (c := self._lexical(plain, slips=True)):
            return "<slip>", c + "?"
        return plain, ""

    @staticmethod
    def _lexical(form: str, slips: bool) -> str:
        for w in (form, form[:-1] if form.endswith("s") else form):
            if w in LEXICON:
                return LEXICON[w]
        if slips and 5 <= len(form) <= _LONGEST_SLIP:
            for word in (form, form[:-1]) if form[-1] == "s" and len(form) > 5 else (form,):
                near = [w for key in _left_out(word) for w in _SLIPS.get(key, ()) if w[0] == form[0] and _swap(word, w)]
                if near:
                    return LEXICON[min(near)]
        return ""

    def read(self, sentence: str) -> tuple[list[str], Counter]:
        """(words, marks) of a sentence; a word of the lexicon stands as its class."""
        text = folded(sentence)
        if _APART.search(text):
            text = _APART.sub(_together, text)
        if not text.isupper():
            text = _NAME.sub(" Nn ", text)
        words, marks = [], Counter()
        for piece in _PIECE.findall(text):
            if piece == "Nn":
                words.append("<name>")
                continue
            w, mark = self.word(piece)
            if not w:
                continue
            if mark:
                kind = mark.rstrip("*@~?")
                marks[mark] += 1
                marks[kind] += kind != mark
                words.append(f"<{kind}>")
            else:
                words.append(w)
                if w in _THREATS:
                    marks["threat"] += 1
                if w in _GROUPS:
                    marks["group"] += 1
        return words, marks


_THREATS, _GROUPS = frozenset(THREATS), frozenset(GROUPS)
#: Marks from which a category is started.
STARTS = {"insult": ("insult", "other*"), "threat": ("threat",), "hatred": ("group",), "sexual": ("sexual",)}


class Features:
    """Numbers of words, pairs and triples of neighbours, marks and lengths that occur often enough.

    A triple is only as frequent as its pairs, so it is looked up behind the number of its first pair.
    """

    def __init__(self, examples: list[tuple[tuple[str, ...], tuple[str, ...]]]):
        single, marks, pairs, triples = Counter(), Counter(), Counter(), Counter()
        for words, said in examples:
            padded = ("<s>", *words, "</s>")
            single.update(set(words))
            marks.update(set(said) | {self.length(words)})
            pairs.update(set(zip(padded, padded[1:])))
            triples.update(set(zip(padded, padded[1:], padded[2:])))
        often = lambda counts: sorted(x for x, n in counts.items() if n >= MIN_SENTENCES)
        self.words = {w: i for i, w in enumerate(often(single))}
        at = len(self.words)
        self.word_count = at
        self.places = self.words | {"<s>": at, "</s>": at + 1}
        self.step = at + 2
        self.marks = {m: self.step + i for i, m in enumerate(often(marks))}
        at = self.step + len(self.marks)
        some = [p for p in often(pairs) if p[0] in self.places and p[1] in self.places]
        self.pairs = {self.places[a] * self.step + self.places[b]: at + i for i, (a, b) in enumerate(some)}
        at += len(some)
        self.triples: dict[int, int] = {}
        for a, b, c in often(triples):
            first = self.pairs.get(self.places.get(a, -1) * self.step + self.places.get(b, -1)) if a in self.places and b in self.places else None
            if first is not None and c in self.places:
                self.triples[first * self.step + self.places[c]] = at
                at += 1
        self.size = at

    @staticmethod
    def length(words) -> str:
        return f"n:{len(words)}" if len(words) < 4 else "n:+"

    def numbers(self, words, marks) -> list[int]:
        """The distinct feature numbers of a sentence."""
        out: set[int] = set()
        places, pairs, triples, step = self.places, self.pairs, self.triples, self.step
        before, pair = places["<s>"], None
        for w in words:
            here = places.get(w)
            if here is None:
                before = pair = None
                continue
            out.add(here)
            now = None
            if before is not None and (now := pairs.get(before * step + here)) is not None:
                out.add(now)
            if pair is not None and (three := triples.get(pair * step + here)) is not None:
                out.add(three)
            before, pair = here, now
        end = places["</s>"]
        if before is not None and (now := pairs.get(before * step + end)) is not None:
            out.add(now)
        if pair is not None and (three := triples.get(pair * step + end)) is not None:
            out.add(three)
        for m in marks:
            if (n := self.marks.get(m)) is not None:
                out.add(n)
        if (n := self.marks.get(self.length(words))) is not None:
            out.add(n)
        return sorted(out)


def categories(rows: list[np.ndarray], width: int, starts: np.ndarray, weight: np.ndarray, folds: np.ndarray) -> np.ndarray:
    """Category of every abusive sentence (its number, -1 for none), by predictions of a mixture fitted on the other folds.

    ``starts`` (sentences, categories) tells which categories the lists point at; it only sets the first
    memberships, sentences without a listed word start in a component of their own.  In every round the
    word counts of the components are summed over the other folds by the present memberships, and the
    fold's sentences are assigned anew.
    """
    starts = np.column_stack([starts, ~starts.any(1)]) + 0.05
    k = starts.shape[1]
    belongs = starts / starts.sum(1, keepdims=True)
    sizes = np.array([len(r) for r in rows], int)
    at = np.repeat(np.arange(len(rows)), sizes)
    columns = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        new = belongs.copy()
        for f in np.unique(folds):
            inside = folds != f if (folds != f).any() else folds == f
            share = belongs * (weight * inside)[:, None]
            counts = np.stack([np.bincount(columns, share[at, j], width) for j in range(k)])
            logs = np.log((counts + 0.1) / (counts + 0.1).sum(1, keepdims=True))
            z = np.stack([np.bincount(at, logs[j][columns], len(rows)) for j in range(k)], axis=1) + np.log(share.sum(0) + 1)
            z = np.exp(z - z.max(1, keepdims=True))
            new[folds == f] = (z / z.sum(1, keepdims=True))[folds == f]
        belongs = new
    best = belongs.argmax(1)
    return np.where((best < k - 1) & (belongs.max(1) >= 0.5), best, -1)


def fit(rows: list[np.ndarray], width: int, y: np.ndarray, weight: np.ndarray, l2: float = 1.0, rounds: int = 120) -> np.ndarray:
    """Weights (and offset, last) of an L2-regularised logistic model over binary features.

    Accelerated gradient descent with a step per coordinate; deterministic.
    """
    sizes = np.array([len(r) for r in rows])
    at = np.repeat(np.arange(len(rows)), sizes)
    columns = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    w, v, k = np.zeros(width + 1), np.zeros(width + 1), 0
    total = np.bincount(columns, weight[at], width)
    curvature = np.append(total * 0.25, weight.sum() * 0.25) * np.sqrt(max(1.0, sizes.mean() if len(sizes) else 1.0)) + l2
    for _ in range(rounds):
        look = w + k / (k + 3) * v
        z = np.bincount(at, look[columns], len(rows)) + look[-1]
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.append(np.bincount(columns, g[at], width), g.sum()) + l2 * np.append(look[:-1], 0.0)
        new = look - grad / curvature
        # the momentum starts anew where it leads uphill; otherwise rounding grows into other weights
        k = 0 if grad @ (new - w) > 0 else k + 1
        v, w = new - w, new
    return w


def probabilities(rows: list[np.ndarray], w: np.ndarray) -> np.ndarray:
    sizes = np.array([len(r) for r in rows], int)
    at = np.repeat(np.arange(len(rows)), sizes)
    z = np.bincount(at, w[np.concatenate(rows)], len(rows)) if len(rows) else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(z + w[-1], -30, 30)))


#: Steps into which a probability of an earlier model is cut as a feature of a later one.
STEPS = 8


def _step(p: float) -> int:
    return min(STEPS - 1, int(p * STEPS))


Example = tuple[tuple[str, ...], tuple[str, ...], int, int, int]


class Chain:
    """The trained chain: features, weights per category and of the last model."""

    def __init__(self, examples: list[Example], known: frozenset[str] = frozenset()):
        """``examples``: (words, marks, whether voted abusive, documents, number of a document), each sentence and verdict once."""
        self.known = known
        self.features = Features([(words, marks) for words, marks, *_ in examples])
        base = self.features.size
        self.width = base + STEPS * len(CATEGORIES)
        if not examples:
            self.weights = [np.zeros(self.width + 1) for _ in range(len(CATEGORIES) + 1)]
            return
        rows = [np.array(self.features.numbers(words, marks), np.int64) for words, marks, *_ in examples]
        voted = np.array([e[2] for e in examples])
        # frequent sentences count less, in the same measure under either verdict
        total = Counter()
        for words, marks, _, n, _ in examples:
            total[words, marks] += n
        copies = np.array([n * min(1.0, 20 / total[words, marks]) for words, marks, _, n, _ in examples])
        folds = np.array([e[4] % FOLDS for e in examples])

        # Votes stand on documents.  A first model takes every sentence of a document for what the
        # document was voted; sentences whose words stand mainly in abusive documents come out high,
        # ordinary ones near the share of abusive documents.  The high ones are the abusive sentences;
        # a second model, trained on them, looks once more.
        # Both are held back strongly, so that only words seen in several documents count.
        lexical = np.array([any(m in ("insult", "sexual", "other*") for m in marks) for _, marks, *_ in examples])
        bar = np.where(lexical, 0.55, 0.7)
        p = probabilities(rows, fit(rows, self.width, voted.astype(float), copies, l2=STRICT))
        target = (voted == 1) & (p >= bar)
        weight = np.where((voted == 1) & ~target, 0.3 * (1 - p), 1.0) * copies
        p = probabilities(rows, fit(rows, self.width, target.astype(float), weight, l2=STRICT))
        target = (voted == 1) & (p >= bar)
        weight = np.where((voted == 1) & ~target, np.where(p > 0.2, 0.05, 0.3), 1.0) * copies

        chosen = np.flatnonzero(target)
        starts = np.array([[any(m in examples[i][1] for m in STARTS[c]) for c in CATEGORIES] for i in chosen], float).reshape(len(chosen), len(CATEGORIES))
        category = np.full(len(rows), -1)
        category[chosen] = categories([rows[i] for i in chosen], base, starts, copies[chosen], folds[chosen])
        self.weights = []
        for j, name in enumerate((*CATEGORIES, "abusive")):
            y = (category == j if name in CATEGORIES else target).astype(float)
            w = fit(rows, self.width, y, weight)
            self.weights.append(w)
            if name in CATEGORIES:
                held = np.zeros(len(rows))
                for f in range(FOLDS):
                    inside, outside = np.flatnonzero(folds != f), np.flatnonzero(folds == f)
                    part = fit([rows[i] for i in inside], self.width, y[inside], weight[inside])
                    held[outside] = probabilities([rows[i] for i in outside], part)
                rows = [np.append(r, base + j * STEPS + _step(q)) for r, q in zip(rows, held)]

    def probabilities(self, rows: list[list[int]]) -> np.ndarray:
        """(sentences, categories and score): the models of the chain one after another over all sentences at once."""
        sizes = np.array([len(r) for r in rows], int)
        at = np.repeat(np.arange(len(rows)), sizes)
        columns = np.fromiter(itertools.chain.from_iterable(rows), np.int64, int(sizes.sum()))
        out = np.zeros((len(rows), len(self.weights)))
        steps: list[np.ndarray] = []
        for j, w in enumerate(self.weights):
            z = np.bincount(at, w[columns], len(rows)) + w[-1]
            for i, step in enumerate(steps):
                z += w[self.features.size + i * STEPS + step]
            out[:, j] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            steps.append(np.minimum(STEPS - 1, (out[:, j] * STEPS).astype(np.int64)))
        return out

    def scorer(self):
        """A function texts -> (texts, categories and score): those of the worst sentence of every text."""
        reader = Reader(self.known)
        memo: dict[str, int] = {}
        kept = np.zeros((0, len(self.weights)))

        def score(texts: list[str | None]) -> np.ndarray:
            nonlocal kept
            if len(memo) >= MEMO:
                memo.clear()
                kept = kept[:0]
            rows: list[list[int]] = []
            numbers: list[int] = []
            ends = [0]
            for text in texts:
                for s in sentences(text):
                    n = memo.get(s)
                    if n is None:
                        n = memo[s] = len(kept) + len(rows)
                        rows.append(self.features.numbers(*reader.read(s)))
                    numbers.append(n)
                ends.append(len(numbers))
            if rows:
                kept = np.concatenate([kept, self.probabilities(rows)])
            out = np.zeros((len(texts), len(self.weights)))
            found = kept[numbers] if numbers else kept[:0]
            for i, (a, b) in enumerate(zip(ends, ends[1:])):
                if b > a:
                    out[i] = found[a + int(found[a:b, -1].argmax())]
            return out

        return score


def _clean_words(sample: DataFrame) -> frozenset[str]:
    """Words that stand in at least two documents voted clean, other than words of the lexicon."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Counter()
            for text in batch.column(0):
                words.update({re.sub(r"[^a-z]", "", p.lower()) for p in _PIECE.findall(folded(text.as_py() or ""))})
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["w", "n"])

    counted = sample.filter("share < 0.5").select("text").mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).filter("n >= 2")
    return frozenset(r["w"] for r in counted.collect() if r["w"] not in LEXICON)


def train(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_sentences: int = MAX_SENTENCES) -> Chain:
    """The chain trained on at most ``max_labelled`` documents that have votes (null votes do not count).

    Their texts are read as a whole where they are; equal sentences of equal verdict are one weighted
    example, and at most ``max_sentences`` of these, chosen by a hash, come to the driver.
    """
    votes = labels.filter("abusive IS NOT NULL").groupBy("doc_id").agg(F.avg("abusive").alias("share"))
    chosen = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    # at most max_labelled rows of two numbers: small enough for every task, so that no text is shuffled
    sample = documents.select("doc_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    known = _clean_words(sample)
    shipped = documents.sparkSession.sparkContext.broadcast(known)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shipped.value)
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [])
            for doc, text, share in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                for s in dict.fromkeys(sentences(text.as_py())):
                    words, marks = reader.read(s)
                    for column, v in zip(columns, (doc, int(share >= 0.5), words, sorted(m for m, n in marks.items() if n))):
                        column.append(v)
            kinds = (pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["d", "v", "words", "marks"])

    rows = sample.select(F.col("doc_id").cast("long"), "text", "share").mapInArrow(read, "d long, v int, words array<string>, marks array<string>")
    equal = rows.groupBy("words", "marks", "v").agg(F.countDistinct("d").alias("n"), F.min("d").alias("d"))
    few = equal.orderBy(F.xxhash64("words", "marks", "v"), "words", "v").limit(max_sentences)
    examples = [(tuple(r["words"]), tuple(r["marks"]), r["v"], r["n"], r["d"] * 0x9E3779B97F4A7C15 % (1 << 64) >> 7) for r in few.collect()]
    return Chain(examples, known)


def scored(documents: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text", extra: list[str] | None = None) -> DataFrame:
    """``(key, *extra, score, insult, threat, hatred, sexual)`` of every document.

    Null and empty texts score 0; whole texts of any length are read sentence by sentence; repeated
    rows are scored alike; without labels every document scores one half or less.
    """
    extra = extra or []
    source = documents.select(F.col(key), *[F.col(c) for c in extra], F.col(text).cast("string").alias("__text"))
    kept = source.schema.fields[:-1]
    shipped = documents.sparkSession.sparkContext.broadcast(chain)
    names = ["score", *CATEGORIES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shipped.value.scorer()
        for batch in batches:
            texts = batch.column(len(kept))
            for first in range(0, len(batch), 1000):
                part = batch.slice(first, 1000)
                values = score([t.as_py() for t in texts.slice(first, 1000)])
                columns = [pa.array(values[:, -1])] + [pa.array(values[:, j]) for j in range(len(CATEGORIES))]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(kept))] + columns, names=[f.name for f in kept] + names)

    return source.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} double" for n in names]))


def rates(scores: DataFrame, source: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """Documents, flagged documents, their rate and the mean score of every source; null is a source of its own."""
    flagged = (F.col("score") >= threshold).cast("long")
    return scores.groupBy(source).agg(F.count(F.lit(1)).alias("documents"), F.sum(flagged).alias("flagged"), F.avg(flagged).alias("rate"), F.avg("score").alias("mean_score"))
