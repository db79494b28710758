"""Languages of texts and of their segments: known words first, then ever shorter character n-grams."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hablon.plans.workers import prepared

CODES = ("hil", "ceb", "tl", "en", "ilo", "es")
# fixed values: spellings of labels, after lower-casing and cutting a region suffix
SPELLINGS = {
    "hil": "hil", "hiligaynon": "hil", "ilonggo": "hil",
    "ceb": "ceb", "cebuano": "ceb", "bisaya": "ceb", "binisaya": "ceb",
    "tl": "tl", "tgl": "tl", "tagalog": "tl", "fil": "tl", "filipino": "tl", "pilipino": "tl",
    "en": "en", "eng": "en", "english": "en",
    "ilo": "ilo", "ilocano": "ilo", "ilokano": "ilo", "iloko": "ilo",
    "es": "es", "spa": "es", "spanish": "es", "espanol": "es", "español": "es",
}
SAMPLE_ROWS = 50_000  # labelled rows the classifier is fitted on at most
LONGEST_GRAM = 5
SHORT_INSERT = 3  # words in another language that make no segment
SWITCH, SWITCH_INSIDE = 4.0, 12.0  # cost of a change of language at a clause mark and elsewhere
SNIPPET = 5  # words of the held-out snippets that confidences are calibrated on
_PARTS = regex.compile(r"[\p{L}\p{M}\p{N}]+(?:['’\-][\p{L}\p{M}\p{N}]+)*|[,.;:!?¡¿\n]")
_WORD = regex.compile(r"^[\p{L}\p{M}]")


def label_code(label: Column) -> Column:
    """The code a label stands for; NULL for missing and unknown ones."""
    key = F.lower(F.trim(F.regexp_replace(label, r"[-_][A-Za-z]{2}\s*$", "")))
    pairs = [F.lit(x) for kv in SPELLINGS.items() for x in kv]
    return F.element_at(F.create_map(*pairs), key)


@dataclass
class Model:
    """Log frequencies of words and, per length, of character n-grams, one value per language."""

    words: dict[str, np.ndarray] = field(default_factory=dict)
    grams: list[dict[str, np.ndarray]] = field(default_factory=list)
    scale: float = 1.0  # of log likelihoods in confidences

    def score(self, word: str, name_like: bool = False) -> np.ndarray:
        """Log likelihoods, lowered by their mean. A capitalised unknown word is most likely a name and says little."""
        known = self.words.get(word)
        if known is not None:
            return known
        if name_like:
            return np.zeros(len(CODES))
        marked = f"<{word}>"
        for n in range(LONGEST_GRAM, 0, -1):
            table = self.grams[n]
            hits = [table[g] for i in range(len(marked) - n + 1) if (g := marked[i : i + n]) in table]
            if len(hits) * 2 >= max(1, len(marked) - n + 1):
                return np.clip(np.mean(hits, axis=0), -2.0, 2.0)
        return np.zeros(len(CODES))


def fit(rows: list[tuple[str, str]]) -> Model:
    """A model of labelled (code, text) rows; rows with other codes or without text are left out."""
    words = {c: Counter() for c in CODES}
    for code, text in rows:
        if code in words and text:
            words[code].update(w.lower() for w in _PARTS.findall(text) if _WORD.match(w))

    def table(counts: dict[str, Counter], smooth: float) -> dict[str, np.ndarray]:
        totals = np.array([sum(counts[c].values()) for c in CODES], float)
        every = set().union(*counts.values())
        out = {}
        for w in every:
            v = np.log((np.array([counts[c][w] for c in CODES], float) + smooth) / (totals + smooth * len(every) + 1))
            out[w] = np.clip(v - v.mean(), -5.0, 5.0)
        return out

    model = Model(table(words, 0.05), [{}])
    for n in range(1, LONGEST_GRAM + 1):
        grams = {c: Counter() for c in CODES}
        for c in CODES:
            for w, k in words[c].items():
                marked = f"<{w}>"
                for i in range(len(marked) - n + 1):
                    grams[c][marked[i : i + n]] += 1
        model.grams.append(table(grams, 0.5))
    return model


def calibrated(rows: list[tuple[str, str]]) -> Model:
    """A model of all rows whose confidences are scaled so that they fit best to snippets of a held-out third of the rows,
    scored by a model of the others. Too few rows leave the scale at 1."""
    model = fit(rows)
    kept, held = [r for i, r in enumerate(rows) if i % 3], [r for i, r in enumerate(rows) if i % 3 == 0]
    judge, sums, right = fit(kept), [], []
    for code, text in held:
        words = [w for w in _PARTS.findall(text or "") if _WORD.match(w)]
        for at in range(0, len(words) - SNIPPET + 1, SNIPPET):
            if code in CODES:
                sums.append(sum(_token_score(w, judge) for w in words[at : at + SNIPPET]))
                right.append(CODES.index(code))
    if len(sums) < 30:
        return model
    x, y = np.asarray(sums), np.asarray(right)

    def loss(scale: float) -> float:
        z = x * scale - (x * scale).max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).mean())

    model.scale = min((0.05 * 1.25**k for k in range(20)), key=loss)
    return model


def _token_score(token: str, model: Model) -> np.ndarray:
    """The score of a word; numbers and marks have none."""
    if not _WORD.match(token):
        return np.zeros(len(CODES))
    low = token.lower()
    return model.score(low, low not in model.words and token[:1].isupper() and not token.isupper())


def _best_path(scores: np.ndarray, cuts: list[bool]) -> list[int]:
    """The language of each word on the path of the highest likelihood less the costs of changes."""
    n, k = scores.shape
    best = scores[0].copy()
    back = np.empty((n, k), np.int8)
    same = np.arange(k)
    for i in range(1, n):
        top = int(best.argmax())
        jump = best[top] - (SWITCH if cuts[i] else SWITCH_INSIDE)
        stay = best >= jump
        back[i] = np.where(stay, same, top)
        best = np.maximum(best, jump) + scores[i]
    path = [int(best.argmax())]
    for i in range(n - 1, 0, -1):
        path.append(int(back[i][path[-1]]))
    path.reverse()
    return path


def _runs(path: list[int]) -> list[list[int]]:
    """[language, first word, last word] of the segments of a path; runs of up to ``SHORT_INSERT`` words join what stands
    around them, or the run that follows at the beginning."""
    runs: list[list[int]] = []
    for i, code in enumerate(path):
        if runs and runs[-1][0] == code:
            runs[-1][2] = i
        else:
            runs.append([code, i, i])
    while len(runs) > 1:
        short = min(range(len(runs)), key=lambda r: runs[r][2] - runs[r][1])
        if runs[short][2] - runs[short][1] + 1 > SHORT_INSERT:
            break
        into = short - 1 if short else 1
        runs[into][1], runs[into][2] = min(runs[into][1], runs[short][1]), max(runs[into][2], runs[short][2])
        del runs[short]
        joined: list[list[int]] = []
        for r in runs:
            if joined and joined[-1][0] == r[0]:
                joined[-1][2] = r[2]
            else:
                joined.append(r)
        runs = joined
    return runs


class Scorer:
    """Scores whole batches of texts; every distinct token is looked up once per worker.

    Tokens are numbered; numbers below 2 stand for marks and for what is neither a mark nor a word.
    """

    MOST_TOKENS = 500_000  # of the table; a fuller one is begun anew with the next batch

    def __init__(self, model: Model) -> None:
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((1024, len(CODES)))
        self.used = 2

    def _add(self, token: str) -> int:
        if not token[0].isalnum():
            n = 0
        elif not _WORD.match(token):
            n = 1
        else:
            n = self.used
            self.used += 1
            if n == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[n] = _token_score(token, self.model)
        self.number[token] = n
        return n

    def _confidence(self, totals: np.ndarray, code: np.ndarray) -> np.ndarray:
        z = np.exp(np.clip((totals - totals.max(1, keepdims=True)) * self.model.scale, -50, 0))
        return z[np.arange(len(code)), code] / z.sum(1)

    def segments(self, texts: list[str | None]) -> list[list[tuple[int, int, str, float]]]:
        """(start, end, language, confidence) of each one-language segment of each text; none for one without words.

        Where no stretch of words of a text speaks for another language by as much as half the least cost of a change, no
        change can pay: the text is one segment in the language that is best over all. The other texts get the best path.
        """
        if len(self.number) > self.MOST_TOKENS:
            self._clear()
        known, add = self.number, self._add
        spans: list[list[tuple[int, int]]] = []
        flat: list[int] = []
        sizes = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            at = []
            for m in _PARTS.finditer(text or ""):
                w = m.group()
                n = known.get(w)
                flat.append(add(w) if n is None else n)
                at.append(m.span())
            spans.append(at)
            sizes[i] = len(at)
        out: list[list[tuple[int, int, str, float]]] = [[] for _ in texts]
        ids = np.asarray(flat, np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        words = np.flatnonzero(ids >= 2)
        if not len(words):
            return out
        place = words - (np.cumsum(sizes) - sizes)[owner[words]]  # among the tokens of the text
        who = owner[words]
        scores = self.table[ids[words]]
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        last = np.r_[first[1:], len(words)] - 1
        totals = np.add.reduceat(scores, first, axis=0)
        top = totals.argmax(1)
        lead = np.cumsum(scores - scores[np.arange(len(words)), np.repeat(top, last - first + 1)][:, None], axis=0)
        before = np.r_[np.zeros((1, len(CODES))), lead[:-1]]
        # each text begins far below the one before it, so that the least value so far is one of its own
        drop = np.repeat(np.arange(len(first)) * (20.0 * len(words) + 1.0), last - first + 1)[:, None]
        lowest = np.minimum.accumulate(before - drop, axis=0)
        rise = np.maximum.reduceat((lead - drop - lowest).max(1), first)
        sure = self._confidence(totals, top)
        for k in range(len(first)):
            i, a, b = int(who[first[k]]), int(first[k]), int(last[k])
            at = spans[i]
            if rise[k] < SWITCH / 2:
                out[i].append((at[place[a]][0], at[place[b]][1], CODES[top[k]], float(sure[k])))
                continue
            # a word may begin a segment cheaply if a mark stands before it
            begin = int(words[a] - place[a])
            row = ids[begin : begin + int(sizes[i])]
            marks = np.cumsum(row == 0)[place[a : b + 1]]
            cuts = [True, *(np.diff(marks) > 0).tolist()]
            runs = _runs(_best_path(scores[a : b + 1], cuts))
            sums = np.asarray([scores[a + f : a + l + 1].sum(0) for _, f, l in runs])
            codes = np.asarray([c for c, _, _ in runs])
            for (c, f, l), v in zip(runs, self._confidence(sums, codes)):
                out[i].append((at[place[a + f]][0], at[place[a + l]][1], CODES[c], float(v)))
        return out


def _model_of(samples: DataFrame) -> Model:
    rows = samples.select("lang", "text").orderBy("sample_id").limit(SAMPLE_ROWS).collect()
    return calibrated([(SPELLINGS.get((r.lang or "").lower(), r.lang), r.text) for r in rows])


_SEGMENT = "seg_no int, start_char int, end_char int, lang string, confidence double"


def _found(df: DataFrame, samples: DataFrame, columns: list[Column], schema: str, rows_of) -> DataFrame:
    """``columns`` of ``df`` (the id ``rid`` and ``text`` among them) and the segments of each text, made into rows by ``rows_of``
    of a batch of column lists and the segments."""
    shared = df.sparkSession.sparkContext.broadcast(_model_of(samples))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for batch in batches:
            yield rows_of(batch, scorer.segments(batch["text"].tolist()))

    return prepared(df).select(*columns).mapInPandas(run, schema)


def identify(df: DataFrame, samples: DataFrame, id_col: str = "row_id", text_col: str = "src") -> DataFrame:
    """``row_id, seg_no, start_char, end_char, lang, confidence``: the one-language segments of each text.

    Segments are numbered from 1; offsets are code points. NULL, empty and wordless texts and rows without an id have no
    segment; a repeated id gives the segments of each of its rows. The model is fitted on at most ``SAMPLE_ROWS`` labelled
    rows, in the order of their ids, and sent to the workers; its size is bounded by that number. Without labelled rows every
    language is equally likely. Confidences are scaled on held-out labelled rows.
    """

    def rows_of(batch: pd.DataFrame, found: list) -> pd.DataFrame:
        return pd.DataFrame([(i, n + 1, *seg) for i, segs in zip(batch["rid"], found) for n, seg in enumerate(segs)], columns=["row_id", "seg_no", "start_char", "end_char", "lang", "confidence"])

    texts = df.where(F.col(id_col).isNotNull())
    return _found(texts, samples, [F.col(id_col).alias("rid"), F.col(text_col).alias("text")], f"row_id long, {_SEGMENT}", rows_of)


def relabel(df: DataFrame, samples: DataFrame, id_col: str = "row_id", text_col: str = "src", label_col: str = "lang_label") -> DataFrame:
    """Segments of the rows whose label is missing, names no language of the row, or cannot name all of them. Each row is
    judged by itself, so nothing is shuffled."""

    def rows_of(batch: pd.DataFrame, found: list) -> pd.DataFrame:
        out = []
        for i, code, segs in zip(batch["rid"], batch["code"], found):
            langs = {s[2] for s in segs}
            if len(langs) > 1 or code not in langs:
                out += [(i, n + 1, *seg) for n, seg in enumerate(segs)]
        return pd.DataFrame(out, columns=["row_id", "seg_no", "start_char", "end_char", "lang", "confidence"])

    texts = df.where(F.col(id_col).isNotNull())
    return _found(texts, samples, [F.col(id_col).alias("rid"), F.col(text_col).alias("text"), label_code(F.col(label_col)).alias("code")], f"row_id long, {_SEGMENT}", rows_of)


def row_languages(df: DataFrame, samples: DataFrame, id_col: str = "row_id", text_col: str = "src", label_col: str = "lang_label") -> DataFrame:
    """One row per text: the language of most of its characters, its confidence, all its languages, the given code.

    The confidence is the mean of that language's segments, weighted by their characters. Texts without words keep their given
    code with confidence 0. A row without an id has NULL there.
    """

    def rows_of(batch: pd.DataFrame, found: list) -> pd.DataFrame:
        out = []
        for i, code, segs in zip(batch["rid"], batch["code"], found):
            size: dict[str, int] = {}
            weight: dict[str, float] = {}
            for start, end, lang, sure in segs:
                size[lang] = size.get(lang, 0) + end - start
                weight[lang] = weight.get(lang, 0.0) + (end - start) * sure
            best = max(size, key=lambda c: (size[c], c), default=None)
            out.append((i, best or code, weight[best] / size[best] if best else 0.0, ",".join(sorted(size)) or None, code))
        return pd.DataFrame(out, columns=["row_id", "lang", "confidence", "langs", "given"]).astype({"row_id": "Int64"})

    schema = "row_id long, lang string, confidence double, langs string, given string"
    return _found(df, samples, [F.col(id_col).alias("rid"), F.col(text_col).alias("text"), label_code(F.col(label_col)).alias("code")], schema, rows_of)
