"""Secrets by a linear-chain conditional random field over all tokens (outside, begin, inside), next to fixed patterns.

Tokens are runs of `[\\w+/=-]` with inner dots; a text is one chain. Features: shape, length, character variety, digits,
first letters, the words and signs around, and whether line and file look like code or settings.

Decoding is exact Viterbi over the whole chain without scoring most tokens in full. A tag path gains over the path outside
by a sum over its tokens, so a token is outside in every best path where its own gain, with all that the tokens after it can
add, stays below `Scan.least`. What a word of the text gains at most is remembered for places without a keyword, = or :
close before it; words below the bound are outside there. All others are scored in full, from the text's end to its start;
a word before more than `MARGIN` is scored in full as well, and the tokens that may still gain are decoded.

The model is fitted on windows of a bounded sample of documents (`sample`, the smallest hashes of doc_id; of each text
a few windows with a secret, with a sign of one and without), labelled by the fixed patterns, together with seeded made-up
settings in formats that those patterns do not know. The driver gets feature rows of at most `sample_runs` windows, never
texts.

Defined cases: a null or empty text has no spans; very long texts are scanned whole; repeated rows and null ids are rows
of their own; an empty table gives no rows; without any sample the made-up settings alone fit the model. Offsets are code
points, ends exclusive. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from array import array
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Covered, text_of
from .crf import Chain, feature_rows

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMED = ("passw", "secret", "token", "key")

TOKEN = re.compile(r"[\w+/=-]+(?:\.[\w+/=-]+)*")
CHUNK = re.compile(r"\S+")
WORDY = re.compile(r"[\w\s]")
SIGN = re.compile(r"[0-9_+/=]|[^\W\d_]{20}|[a-z][A-Z]|[^\W_]-[^\W_]+-[^\W_]")
KEYWORDS = re.compile(r"(?i)pass|pwd|secret|token|key|auth|bearer|credential|private")
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
KINDS = ("assign", "access", "hex", "crf")

SAMPLE = 4000
SAMPLE_RUNS = 4000
CONTEXT = 48
# Tokens of a window that the model is fitted on, and windows of a kind taken from one text.
WINDOW = 12
PER_TEXT = 2

# What may follow a word for the next one to be judged by its remembered bound; the ends of each belong to it too.
ENDINGS = ("", ",", ".", ";", "!", "?", ")", '"', "'", ",\"", ".\"", "!\"", "?\"", "),", ").")
FULL, ODD, CUE = 1, 2, 4  # a chunk is scored in full; so is the next one; so are all within CONTEXT
MARGIN = 4.0
LONG = 40
SHORT = 1 << 20  # texts up to so many characters are split as a whole
REMEMBERED = 300_000


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the secret itself), by start, then kind."""
    out = []
    lowered = text.lower()
    if any(w in lowered for w in NAMED):
        out += [(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _bucket(x: float, steps) -> int:
    return bisect_right(steps, x)


def file_features(text: str) -> str:
    return "code" if "{" in text and ";" in text else "settings" if text.count("=") * 40 > text.count(" ") + 1 else "prose"


SHAPE = str.maketrans(
    "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "a" * 26 + "A" * 26 + "0" * 10
)
AGAIN = re.compile(r"(.)\1+")


def own_features(token: str) -> tuple:
    shape = AGAIN.sub(r"\1", token[:64].translate(SHAPE))[:8]
    if token.isalpha():
        digits, letters = 0, len(token)
    else:
        digits = sum(c.isdigit() for c in token)
        letters = sum(c.isalpha() for c in token)
    upper = 0 if token.islower() else sum(c.isupper() for c in token)
    return (
        shape,
        _bucket(len(token), (4, 8, 12, 16, 20, 24, 32, 40, 64)),
        f"{_bucket(len(set(token)), (4, 8, 12, 16, 22))}:{_bucket(len(token), (12, 20, 32))}",
        f"{_bucket(digits / len(token), (0.01, 0.1, 0.3, 0.6, 1.0))}:{letters > 0}",
        f"{_bucket(upper / max(1, letters), (0.01, 0.2, 0.6, 1.0))}",
        token[:3] if letters else "0",
    )


def signs(text: str) -> str:
    """The last two characters that are no word."""
    return WORDY.sub("", text)[-2:]


def around_features(text: str, start: int, end: int, kind_of_file: str) -> tuple:
    line = text[max(0, start - CONTEXT) : start].rpartition("\n")[2]
    words = TOKEN.findall(line)[-2:]
    gap = signs(line[line.rfind(words[-1]) + len(words[-1]) :] if words else line)
    near = "key" if words and KEYWORDS.search(words[-1]) else "word" if words else "start"
    far = "key" if len(words) > 1 and KEYWORDS.search(words[-2]) else "word"
    cued = "=" in line or ":" in line
    return (
        f"{near}:{bool(set('=:') & set(gap))}",
        f"{far}:{near}",
        f"{gap}|{text[end : end + 1].strip()}",
        f"{kind_of_file}:{cued}",
        f"{('plain' if words[-1].isalpha() and words[-1].islower() else 'odd') if words else ''}|{gap}|{cued}",
    )


OWN = 6  # features of the token alone; the others are of what is around it


def token_features(text: str, start: int, end: int, kind_of_file: str) -> list[int]:
    return feature_rows((*own_features(text[start:end]), *around_features(text, start, end, kind_of_file)))


def windows(text: str):
    """(kind, tokens, tags) per window of the text, tags from the fixed patterns; a window ends outside of their spans.

    Kinds: 0 with a secret, 1 with a sign of one, 2 without.
    """
    spans, at = [(s[3], s[1]) for s in base_spans(text)], 0
    tokens, tags, last = [], [], None

    def window():
        piece = text[max(0, tokens[0][0] - CONTEXT) : tokens[-1][1]]
        return 0 if any(tags) else 1 if SIGN.search(piece) or KEYWORDS.search(piece) else 2, tokens, tags

    for m in TOKEN.finditer(text):
        start, end = m.span()
        while at < len(spans) and spans[at][1] <= start:  # tokens come in order: it meets none of those to come
            at += 1
        inside = next(((a, b) for a, b in spans[at : at + len(KINDS)] if start < b and end > a), None)
        if inside is None and len(tokens) >= WINDOW:
            yield window()
            tokens, tags = [], []
        tokens.append((start, end))
        tags.append(OUTSIDE if inside is None else INSIDE if inside == last else BEGIN)
        last = inside
    if tokens:
        yield window()


def tagged_runs(text: str, most: int | None = None):
    """(feature rows, tags) per window: what the model is fitted on. most: of a kind, those with the smallest checksums."""
    found = list(windows(text))
    if most is not None:
        check = lambda w: (zlib.crc32(text[w[1][0][0] : w[1][-1][1]].encode("utf-8", "replace")), w[1])
        found = [w for k in range(3) for w in sorted((w for w in found if w[0] == k), key=check)[:most]]
    kind = file_features(text) if found else ""
    for _, tokens, tags in found:
        yield [token_features(text, a, b, kind) for a, b in tokens], tags


def made_up(seed: int = 11, n: int = 600):
    """Seeded settings and sentences: secrets in formats that the fixed patterns do not know, and harmless look-alikes."""
    r = random.Random(seed)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda k, a=alnum: "".join(r.choice(a) for _ in range(k))
    syllables = lambda k: "".join(r.choice("bcdfghlmnprstvw") + r.choice("aeiouy") for _ in range(k))
    plain = lambda k: " ".join(syllables(r.randint(1, 5)) for _ in range(k))
    for _ in range(n):
        secret = r.choice(
            (
                f"ghp_{some(36)}",
                f"sk_live_{some(24)}",
                f"xoxb-{some(12, '0123456789')}-{some(24)}",
                f"eyJ{some(20)}.{some(40)}.{some(30)}",
                some(r.randint(24, 48)),
                some(r.randint(28, 44), alnum + "+/") + "=",
            )
        )
        name = r.choice(("authorization: Bearer", "private_credential", "auth", "pwd =", "use credential", "Bearer"))
        mark, apart = r.choice(("", "", "'", '"')), r.choice((" ", " ", "\n", ", ", "; ", ". ", " | ", " ### "))
        yield f"{name} {mark}{secret}{mark}{apart}{plain(r.randint(0, 5))} ", secret
    for _ in range(n):
        harmless = r.choice(
            (
                some(16, "0123456789"),
                ".".join(str(r.randint(0, 255)) for _ in range(4)),
                f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}",
                f"555-{some(4, '0123456789')}",
                f"item_{some(3, '0123456789')}",
                f"{some(8)}/{some(6, 'abcdefgh')}",
                f"and/or_{some(4, 'abc')}",
                "x" * r.randint(20, 40),
                some(r.randint(20, 60), "abcdefghijklmnopqrstuvwxyz"),
            )
        )
        yield f"{r.choice(('on the', 'page', 'key', 'call', 'the value ='))} {harmless} ", None
    for _ in range(n):  # secrets of words, known by what is around them, and the same forms elsewhere
        words = ["".join(r.choice("bcdfghlmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(5)]
        forms = (words[0] + words[1].title() + words[2].title(), "-".join(words[:4]), words[0] + words[1] + words[2])
        phrase = " ".join(words[: r.randint(3, 5)])
        name = r.choice(("pwd =", "pwd:", "passphrase:", "credential =", "auth_key =", "Bearer", "private ="))
        secret = r.choice(forms)
        yield f"{name} {secret}\n{plain(r.randint(0, 5))}", secret
        yield f"{r.choice(('passphrase:', 'passphrase =', 'pwd phrase ='))} {phrase}\n{plain(r.randint(0, 3))}", phrase
        yield f"{r.choice(('on the', 'name =', 'page', 'call'))} {r.choice(forms[:2])} of ", None
        yield f"{r.choice(('the key', 'private', 'a secret', 'the token', 'keyboard', 'passing'))} {words[3]} of {words[4]} ", None
        yield f"the key: {r.choice(('the', 'it', 'a', 'we'))} {words[2]} {r.choice(('of', 'is', 'and'))} {words[3]} ", None
    for _ in range(n):  # plain sentences
        sign, mark = r.choice((",", ";", " and", " of", " (", ' "', "\n", " |")), r.choice(("", "", "'", '"'))
        yield f"{plain(4).capitalize()}{sign} {mark}{plain(2)}{mark} {plain(3)}{r.choice('.!?')} ", None


def made_up_runs(seed: int = 11):
    for text, secret in made_up(seed):
        at = text.rfind(secret) if secret else -1
        rows, tags, open_ = [], [], False
        for m in TOKEN.finditer(text):
            start, end = m.span()
            inside = secret is not None and start < at + len(secret) and end > at
            tags.append(OUTSIDE if not inside else INSIDE if open_ else BEGIN)
            rows.append(token_features(text, start, end, "prose"))
            open_ = inside
        yield rows, tags


def fit(docs: DataFrame, sample: int = SAMPLE, sample_runs: int = SAMPLE_RUNS) -> Chain:
    """The model from at most `sample` documents and `sample_runs` of their windows, those with the smallest hashes."""
    order = F.xxhash64(F.lit("secret sample"), "doc_id")
    chosen = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(order, "doc_id").limit(sample)
    texts = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select(text_of().alias("text"))

    def extract(batches):
        for batch in batches:
            rows, tags = [], []
            for text in batch["text"]:
                for r, t in tagged_runs(text, PER_TEXT):
                    rows.append([x for token in r for x in token])
                    tags.append(t)
            if rows:
                yield pd.DataFrame({"rows": rows, "tags": tags})

    found = texts.mapInPandas(extract, "rows array<int>, tags array<int>")
    key = F.xxhash64("rows", "tags")
    early = F.pmod(key, F.when(F.exists("tags", lambda t: t > OUTSIDE), 250).otherwise(1000))  # windows with a secret are few
    runs = []
    for flat, tags in found.orderBy(early, key, "rows", "tags").limit(sample_runs).collect():
        width = len(flat) // len(tags)
        runs.append(([flat[i : i + width] for i in range(0, len(flat), width)], list(tags)))
    return Chain.fit(runs + list(made_up_runs()), 3)


class _Flags(dict):
    """Flags of the chunks seen so far."""

    def __init__(self, flag):
        super().__init__()
        self.flag = flag

    def __missing__(self, chunk: str) -> int:
        flag = self.flag(chunk)
        if len(chunk) <= LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[chunk] = flag
        return flag


class Scan:
    """A model made ready for texts: what a tag gains over outside per feature row, and what is remembered of words."""

    def __init__(self, model: Chain):
        self.model = model
        self.gain = (model.emission[:, 1:] - model.emission[:, :1]).tolist()
        t = model.transition
        # the most that a step into a tag adds over staying outside, and the least gain of a token that may be in a span
        self.into = (t[:, BEGIN].max() - t[0, 0], t[:, INSIDE].max() - t[0, 0])
        self.least = float(t[:, 0].min() - t[1:, 0].max())
        self.owned: dict[str, tuple[float, float]] = {}
        self.forms: dict[tuple, tuple[float, float]] = {}
        self.heads: dict[str, tuple[float, float]] = {}
        self.around: dict[tuple, tuple[float, float]] = {}
        self.bounds: dict[tuple, tuple[float, float]] = {}
        self.flags: dict[str, _Flags] = {}

    def _sum(self, features, first: int = 0) -> tuple[float, float]:
        """What begin and inside gain by features, of which `first` come before."""
        rows = [self.gain[r] for r in feature_rows((None,) * first + tuple(features))[first:]]
        return sum(r[0] for r in rows), sum(r[1] for r in rows)

    def _own(self, token: str) -> tuple[float, float]:
        found = self.owned.get(token)
        if found is None:
            if token.isascii() and token.isalpha() and token.islower():  # most words: their form is their length and variety
                key, head = (len(token), len(set(token))), token[:3]
                features = None
            else:
                *key, head = features = own_features(token)
                key = tuple(key)
            form, start = self.forms.get(key), self.heads.get(head)
            if form is None or start is None:
                features = features or own_features(token)
                for known in (self.forms, self.heads):
                    if len(known) >= REMEMBERED:
                        known.clear()
                form = self.forms[key] = self._sum(features[:-1])
                start = self.heads[head] = self._sum(features[-1:], OWN - 1)
            found = form[0] + start[0], form[1] + start[1]
            if len(token) <= LONG:
                if len(self.owned) >= REMEMBERED:
                    self.owned.clear()
                self.owned[token] = found
        return found

    def _around(self, features: tuple) -> tuple[float, float]:
        found = self.around.get(features)
        if found is None:
            if len(self.around) >= REMEMBERED:
                self.around.clear()
            found = self.around[features] = self._sum(features, OWN)
        return found

    def _bound(self, ahead: str, first: bool, after: str, kind_of_file: str) -> tuple[float, float]:
        """The most that what is around a token gains without a keyword, = or : near; first: a chunk's first token, after
        any of ENDINGS or at a line's start; ahead: the signs before it in the chunk."""
        key = ahead, first, after, kind_of_file
        found = self.bounds.get(key)
        if found is None:
            gaps = {(e + ahead)[-2:] for e in ENDINGS} if first else {ahead}
            sums = [
                self._sum(
                    (f"{near}:False", f"word:{near}", f"{gap}|{after}", f"{kind_of_file}:False", f"{word}|{gap}|False"), OWN
                )
                for gap in gaps
                for near, word in (("word", "plain"), ("word", "odd"), ("start", ""))
            ]
            if len(self.bounds) >= REMEMBERED:
                self.bounds.clear()
            found = self.bounds[key] = max(x[0] for x in sums), max(x[1] for x in sums)
        return found

    def _most(self, begin: float, inside: float) -> float:
        return max(begin + self.into[0], inside + self.into[1])

    def _flag(self, chunk: str, kind_of_file: str) -> int:
        """FULL: a token may gain more than `least` - MARGIN after plain words; ODD: it ends in other signs than ENDINGS, or
        has no token; CUE: a keyword, = or :"""
        flag = CUE if "=" in chunk or ":" in chunk or KEYWORDS.search(chunk) else 0
        if chunk.isalpha() and len(chunk) <= LONG:  # most chunks: one token without signs
            around, (begin, inside) = self._bound("", True, "", kind_of_file), self._own(chunk)
            return flag | (FULL if self._most(begin + around[0], inside + around[1]) >= self.least - MARGIN else 0)
        last, odd = None, FULL | ODD
        for m in TOKEN.finditer(chunk):
            start, end = m.span()
            if not flag & FULL and len(chunk) <= LONG:
                ahead = signs(chunk[last or 0 : start]) if start > (last or 0) else ""
                around = self._bound(ahead, last is None, chunk[end : end + 1], kind_of_file)
                begin, inside = self._own(m[0])
                if self._most(begin + around[0], inside + around[1]) >= self.least - MARGIN:
                    flag |= FULL
            last, odd = end, 0
        if not odd and last < len(chunk) and signs(chunk[last:]) not in ENDINGS:
            odd = ODD
        return flag | odd | (FULL if len(chunk) > LONG else 0)

    def _wanted(self, text: str, kind_of_file: str):
        """Starts of all chunks, and the numbers of those to be scored in full."""
        if kind_of_file not in self.flags:
            self.flags[kind_of_file] = _Flags(lambda chunk: self._flag(chunk, kind_of_file))
        known = self.flags[kind_of_file]
        chunks = text.split() if len(text) <= SHORT else []
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        if chunks and sizes.sum() + len(chunks) - 1 == len(text.strip()):  # one blank between them
            flags = bytes(map(known.__getitem__, chunks))
            if not any(flags):
                return (), []
            first = len(text) - len(text.lstrip())
            starts = (first + np.cumsum(sizes + 1) - sizes - 1).tolist()
        else:
            starts, flags = array("q"), bytearray()
            for m in CHUNK.finditer(text):
                starts.append(m.start())
                flags.append(known[m[0]])
        wanted = bytearray(len(flags) + 1)
        done = 0
        for i in np.flatnonzero(np.frombuffer(flags, np.uint8)).tolist():
            flag = flags[i]
            if flag & (FULL | CUE):
                wanted[i] = 1
            if flag & ODD:
                wanted[i + 1] = 1
            if flag & CUE:
                reach, done = CHUNK.match(text, starts[i]).end() + CONTEXT, max(done, i)
                while done < len(flags) and starts[done] < reach:
                    wanted[done] = 1
                    done += 1
        return starts, np.flatnonzero(np.frombuffer(wanted, np.uint8)[:-1]).tolist()

    def runs(self, text: str) -> list[list[tuple[int, int, float, float]]]:
        """Neighbouring tokens that may be in a span, with what begin and inside gain; all others are outside."""
        kind = file_features(text)
        starts, wanted = self._wanted(text, kind)
        runs: list[list] = []
        last, after, near = None, 0.0, False  # after: what the tokens from here on gain at most; near: the last one is in a run
        while wanted or last and after > MARGIN:
            if last and after > MARGIN and (not wanted or wanted[-1] < last - 1):
                j = last - 1
            else:
                j = wanted.pop()
                if last is not None and j < last - 1:
                    after, near = 0.0, False  # a plain word lies between
            last = j
            stop = CHUNK.match(text, starts[j]).end()
            for m in reversed(list(TOKEN.finditer(text, starts[j], stop))):
                start, end = m.span()
                own, around = self._own(m[0]), self._around(around_features(text, start, end, kind))
                begin, inside = own[0] + around[0], own[1] + around[1]
                after = self._most(begin, inside) + max(0.0, after)
                if after >= self.least:
                    if not near:
                        runs.append([])
                    runs[-1].append((start, end, begin, inside))
                near = after >= self.least
        return [run[::-1] for run in reversed(runs)]

    def spans(self, text: str) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for run in self.runs(text):
            tags = self.model.path(np.array([(0.0, begin, inside) for _, _, begin, inside in run]))
            for (start, end, _, _), tag in zip(run, tags):
                if tag == INSIDE and out and out[-1][1] <= start and not text[out[-1][1] : start].strip():
                    out[-1] = (out[-1][0], end)
                elif tag != OUTSIDE:
                    out.append((start, end))
        return out


def method_spans(text: str, model: Chain | Scan) -> list[tuple[int, int]]:
    return (model if isinstance(model, Scan) else Scan(model)).spans(text)


def all_spans(text: str, model: Chain | Scan) -> list[tuple[int, int, str]]:
    """Pattern spans, and the model's that meet none of them, by start, then kind."""
    base = [(a, b, k) for a, b, k, _ in base_spans(text)]
    known = Covered((a, b) for a, b, _ in base)
    added = [(a, b, "crf") for a, b in method_spans(text, model) if not known.meets(a, b)]
    return sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, model: Chain | None = None) -> DataFrame:
    """One row per document: pattern counts and digest, and all spans. One pass, no shuffle."""
    model = model or fit(docs)

    def rows(batches):
        ready = Scan(model)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                spans = all_spans(text, ready)
                base = [s for s in spans if s[2] != "crf"]
                counts = [sum(s[2] == k for s in base) for k in KINDS[:3]]
                out.append((doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            yield frame.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(rows, SCHEMA)
