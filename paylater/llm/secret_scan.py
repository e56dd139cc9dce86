"""Secrets in texts: fixed patterns, and values that are hard to guess where a credential stands.

Patterns find assignments, access ids and hexadecimal strings.  The method adds
values in a credential's context (``pwd: ...``, ``auth=...``) whose guess cost
is high: a dynamic program finds the cheapest way to compose the value of
common words, dates, repeats, sequences, keyboard walks and brute-force spans.
Placeholders and everyday passwords are cheap, and stay unmarked.  Values of one
class (digits, small or capital letters, with symbols or without) are prose
more often: their cost counts a large word list, and they must be spelled unlike words.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylater.llm import documents
from paylater.llm.vocabulary import byte_pieces, public_path, tokenizer_text

# The base patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 12
# A run shorter than the least length holds no other match, so the length is part of these patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "value")
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Context words of the method, and the value after them.
CONTEXT = re.compile(
    r"(?<![a-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|login|auth(?:orization)?|bearer"
    r"|(?:api|access|private|client|account)[_\-\x20]?key)[\"']?\x20*(?:[:=]|=>)\x20*[\"']?([^\s\"'<>]+)",
    re.IGNORECASE | re.ASCII)
CONTEXT_HINTS = ("pass", "pwd", "pin", "secret", "token", "credential", "login", "auth", "bearer", "key")

LEAST_VALUE = 8
LEAST_PART = 3.0          # log10 of the guesses that a part behind a comma or semicolon adds, if it belongs to a value
PARTS = re.compile("([,;])")
SENTENCE_END = re.compile(r"[)\]}*]*[.:?!]*[)\]}*]*$")
LEAST_COST = 9.0          # log10 of the guesses that make a value a secret
LEAST_STRANGE = 1.4       # of values of one class: spelled unlike words
VOCABULARY = "word_bpe_49k.json"
LONGEST_SPAN = 64
JOIN_COST = math.log10(4)  # for each further span

# Common password words, most frequent first.
WORDS = """password admin welcome login master hello dragon monkey letmein football baseball shadow sunshine princess
qwerty superman batman trustno iloveyou michael jordan hunter killer soccer hockey ranger buster thomas robert george
charlie andrew michelle jessica pepper ginger maggie summer winter spring autumn secret freedom whatever computer
internet service server database root user guest test testing example sample demo changeme default public private
access account system network manager office company business money love lover angel baby family mother father
brother sister friend happy lucky star flower orange banana apple cherry cookie cheese chicken tiger lion eagle
falcon phoenix mustang corvette ferrari mercedes yamaha harley london paris berlin madrid america canada australia
texas dallas chelsea arsenal liverpool barcelona january february march april june july august september october
november december monday tuesday friday sunday blue green black white silver purple yellow diamond crystal magic
wizard matrix ninja pirate rocket thunder storm dream music guitar dancer player gamer token key pass word
your here insert replace todo none null value string""".split()
RANK = {w: i + 1 for i, w in enumerate(dict.fromkeys(WORDS))}
LEET = str.maketrans("013457@$!", "oieastasi")
KEY_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
DATE = re.compile(r"(?:\d{1,4}[-/._]\d{1,2}[-/._]\d{1,4}|(?:19|20)\d{6}|\d{4}(?:19|20)\d\d|(?:19|20)\d\d)")


def _neighbours() -> set[tuple[str, str]]:
    at = {c: (x + 0.5 * (y > 0) + 0.25 * max(y - 1, 0), y) for y, row in enumerate(KEY_ROWS) for x, c in enumerate(row)}
    return {(a, b) for a in at for b in at
            if a != b and abs(at[a][0] - at[b][0]) <= 1 and abs(at[a][1] - at[b][1]) <= 1}


NEXT_KEYS = _neighbours()


def _case_cost(text: str) -> float:
    """Ways to capitalise a word like this, as a logarithm."""
    upper = sum(c.isupper() for c in text)
    if not upper:
        return 0.0
    if text[0].isupper() and upper == 1 or upper == len(text):
        return math.log10(2)
    return math.log10(sum(math.comb(len(text), i) for i in range(1, min(upper, len(text) - upper) + 1)) + 1)


def spans_of(value: str, ranks: dict[str, int] = RANK, longest: int = 12) -> Iterator[tuple[int, int, float]]:
    """Start, end and log10 guesses of every known pattern in a value."""
    lower = value.lower()
    plain = lower.translate(LEET) if len(lower.translate(LEET)) == len(lower) else lower
    n = len(value)
    again = [[0] * (n + 1) for _ in range(9)]                 # how far a value equals itself, a unit on
    for unit in range(1, 9):
        for i in range(n - unit - 1, -1, -1):
            again[unit][i] = again[unit][i + 1] + 1 if lower[i] == lower[i + unit] else 0
    far = list(range(1, n + 1))                               # where a keyboard walk ends
    turned, capital = [0] * (n + 1), [0] * (n + 1)
    for i in range(n - 2, -1, -1):
        if (lower[i], lower[i + 1]) in NEXT_KEYS:
            far[i] = far[i + 1]
    for i in range(n):
        turned[i + 1] = turned[i] + (i > 1 and ord(lower[i]) - ord(lower[i - 1]) != ord(lower[i - 1]) - ord(lower[i - 2]))
        capital[i + 1] = capital[i] + value[i].isupper()
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            for form, extra in ((lower, 0.0), (plain, 0.5)):
                for word, more in ((form[i:j], 0.0), (form[i:j][::-1], 0.3)):
                    if word in ranks and (form is lower or plain[i:j] != lower[i:j]):
                        yield i, j, math.log10(ranks[word]) + extra + more + _case_cost(value[i:j])
        date = DATE.match(value, i)
        if date:
            yield i, date.end(), math.log10(365 * 60) if date.end() - i > 4 else math.log10(60)
        for unit in range(1, 9):                              # repeats of a unit
            j = i + unit + again[unit][i] // unit * unit
            if j - i >= 2 * unit and j - i >= 3:
                yield i, j, unit + math.log10((j - i) // unit)
        for delta in (1, -1):                                 # abc, 321
            j = i + 1
            while j < n and ord(value[j]) - ord(value[j - 1]) == delta:
                j += 1
            if j - i >= 3:
                yield i, j, math.log10(26 * (j - i)) + (delta < 0) * math.log10(2)
        j = far[i]                                            # keyboard walk
        if j - i >= 4:
            case = _case_cost(value[i:j]) if capital[j] > capital[i] else 0.0
            yield i, j, math.log10(47 * 5 * (j - i)) + 0.4 * (turned[j] - turned[i + 2]) + case


def guess_cost(value: str, ranks: dict[str, int] = RANK, longest: int = 12) -> float:
    """log10 of the guesses for the cheapest composition of a value."""
    best = [0.0] + [math.inf] * len(value)
    ending: dict[int, list[tuple[int, float]]] = {}
    for i, j, cost in spans_of(value, ranks, longest):
        ending.setdefault(j, []).append((i, cost))
    for j in range(1, len(value) + 1):
        for i in range(max(0, j - LONGEST_SPAN), j):          # brute force: ten guesses a character
            best[j] = min(best[j], best[i] + (j - i) + (i > 0) * JOIN_COST)
        for i, cost in ending.get(j, ()):
            best[j] = min(best[j], best[i] + cost + (i > 0) * JOIN_COST)
    return best[-1]


class Words:
    """The words of a public tokenizer's vocabulary by rank, after the common ones, and their spelling."""

    LONGEST = 20
    LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u024f]+")

    def __init__(self, tokenizer: str):
        flat, at = byte_pieces(tokenizer)
        self.ranks = dict(RANK)
        for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
            word = flat[low:high].tobytes().removesuffix(b"</w>").decode("utf-8", "ignore").lower()
            if len(word) >= 3 and word.isalpha():
                self.ranks.setdefault(word, len(self.ranks) + 1)
        self.grams: Counter[str] = Counter()
        for word in self.ranks:
            if len(word) >= 4 and self.LETTERS.fullmatch(word):
                self.grams.update(g for i in range(len(word)) for g in ("", word[i], word[max(0, i - 1):i + 1],
                                                                        word[max(0, i - 2):i + 1])[:i + 2])

    def strange(self, value: str) -> float:
        """Mean -log10 of the odds of each letter after the two before it; infinite without letters.

        Letters of other scripts, whose words the list doesn't hold, count as ordinary.
        """
        costs = [0.0 for c in value if c.isalpha() and not self.LETTERS.fullmatch(c.lower())]
        for run in self.LETTERS.findall(value.lower()):
            for i in range(len(run)):
                odds = 0.001
                for n, share in ((0, 0.1), (1, 0.3), (2, 0.6)):
                    before = run[max(0, i - n):i]
                    odds += share * self.grams[before + run[i]] / max(1, self.grams[before])
                costs.append(-math.log10(odds))
        return sum(costs) / len(costs) if costs else math.inf


@functools.cache
def words_of(tokenizer: str) -> Words:
    return Words(tokenizer)


def public_words() -> Words:
    return words_of(tokenizer_text(public_path(VOCABULARY)))


def _mixed(value: str) -> bool:
    """Two of digits, small and capital letters; all others are held against words and spelling, too."""
    return (any(c.isdigit() for c in value) + any(c.islower() for c in value) + any(c.isupper() for c in value)) > 1


def _covered(start: int, end: int, spans: list[tuple[int, int]]) -> bool:
    """Whether the spans, in order, hold all of ``start`` to ``end``."""
    for s, e in spans:
        if s <= start < e:
            start = e
    return start >= end


def secret_cost(value: str, words: Callable[[], Words] = public_words) -> float | None:
    """The guess cost of a value that is a secret; none of others."""
    cost = guess_cost(value)
    if cost >= LEAST_COST and not _mixed(value):
        known = words()
        if known.strange(value) < LEAST_STRANGE:
            return None
        cost = guess_cost(value, known.ranks, known.LONGEST)
    return cost if cost >= LEAST_COST else None


def value_in(run: str) -> str:
    """The value at the start of a run without white space.

    Every comma and semicolon is a possible end: the part behind one belongs to the value if it is as hard to guess
    as ``LEAST_PART`` tells, and isn't a field of its own (``name=``).  Marks that end a sentence or
    close a bracket go if they follow a letter or digit, exclamation marks only where the value has no other symbol.
    """
    value, *rest = PARTS.split(run)
    cost = guess_cost(value)
    for mark, part in zip(rest[::2], rest[1::2]):
        longer = value + mark + part
        if not value or not part or ":" in part or "=" in part or guess_cost(longer) - cost < LEAST_PART:
            break
        value, cost = longer, guess_cost(longer)
    tail = SENTENCE_END.search(value).start()
    if 0 < tail < len(value) and value[tail - 1].isalnum():
        if "!" not in value[tail:] or value[:tail].isalnum():
            value = value[:tail]
    return value


def find(text: str, words: Callable[[], Words] = public_words) -> list[tuple[str, int, int, float | None]]:
    """Kind, start, end (code points) and guess cost of the secrets of a text, in order."""
    lower = text.lower()
    found = [("access", *m.span(), None) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [("hex", *m.span(), None) for m in HEX.finditer(text)]
    if any(h in lower for h in ASSIGN_HINTS):
        found += [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if any(h in lower for h in CONTEXT_HINTS):
        taken = sorted((s, e) for _, s, e, _ in found)
        for m in CONTEXT.finditer(text):
            start, end = m.span(1)
            value = value_in(m[1])
            end = start + len(value)
            if len(value) < LEAST_VALUE or _covered(start, end, taken):
                continue
            cost = secret_cost(value, words)
            if cost is not None:
                found.append(("value", start, end, cost))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


SPANS = "array<struct<kind:string,begin:bigint,finish:bigint,cost:double>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("finish", pa.int64()),
                                ("cost", pa.float64())]))


def _sent_words(docs: DataFrame) -> Callable[[], Words]:
    """The word list for tasks; read where the first value needs it."""
    text = docs.sparkSession.sparkContext.broadcast(tokenizer_text(public_path(VOCABULARY)))
    return lambda: words_of(text.value)


def _scan(words: Callable[[], Words]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "begin", "finish", "cost"), x)) for x in find(text or "", words)]
                     for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, SPAN_TYPE)], ["doc_id", "spans"])
    return run


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row: the secrets by start, with the guess cost of those the method adds.

    Null and empty texts have none.  Rows are kept one for one, whatever
    their ids; other columns are not read.
    """
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(_scan(_sent_words(docs)), f"doc_id long, spans {SPANS}"))


def redact_text(text: str, mark: str, words: Callable[[], Words] = public_words) -> str:
    out, at = [], 0
    for _, start, end, _ in find(text, words):
        if end > at:
            out += [text[at:max(start, at)], mark if start >= at else ""]
            at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """``docs`` with ``mark`` in place of each secret of the text; all rows and columns stay."""
    column = docs.columns.index(text_col)
    words = _sent_words(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redact_text(t, mark, words) for t in batch.column(column).to_pylist()]
            yield batch.set_column(column, batch.schema.field(column), pa.array(texts, batch.schema.field(column).type))
    return docs.mapInArrow(run, docs.schema)


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Counts and digests of the secrets of every document."""
    out = find_secrets(documents.read(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    line = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["finish"].cast("string"))), ",")
    return out.select("doc_id", n("assign"), n("access"), n("hex"),
                      F.sha2(line(F.filter("spans", lambda s: s["kind"] != "value")), 256).alias("base_sha256"),
                      line(F.col("spans")).alias("spans"))
