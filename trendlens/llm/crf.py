"""Secrets by patterns and a linear-chain conditional random field.

Spans of the base patterns (assignments to secret names, access keys, long hexadecimal runs) are
always reported.  A linear-chain CRF tags the tokens of every line as begin of a secret, inside or
outside, from the token's shape (length, kinds of characters, share of digits and vowels, changes
between kinds), the words, signs and shapes around it, and features of the whole file (density of
assignments and code signs, length of lines).  Viterbi decoding gives the best tags; runs that don't
overlap a base span are added as kind ``learned``.

The CRF is trained by weak supervision: of windows around base spans, around other tokens with
digits and at places chosen by hash, the ``SAMPLE`` distinct ones of each sort with the least content
hashes are taken (a bound, whatever the corpus), and the values of the base spans are their labels.  Each
window with a secret is also taken with its words and file hidden, and with its kinds of characters
hidden too, so that the rest has to do: neither a name that no pattern knows (``credential: ...``) nor
letters of another case hide a secret.  Training is
full-batch and in a fixed order, so equal corpora give equal models however they are partitioned.

Tagging is array work on some documents at a time: all tokens are one chain in which a line's first
token forgets what was before.  The chain is cut into blocks that are decoded side by side for each tag
they may be entered with; joining the blocks in order gives the exact best path, so one very long line
costs no more than many short ones.

Defined results: null and empty texts have no spans (counts 0, empty string); repeated rows each get a
row; an empty table gives no rows; without a base span in the corpus the model adds nothing; offsets
are code points; carried columns come back in one struct, so no name can clash.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written
from .lines import _powers

KINDS = ("assign", "access", "hex", "learned")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
NAMES = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
DIGIT = re.compile(r"\w*[0-9]\w*")
BLANK = re.compile(r"\s")

SAMPLE = 600  # windows of each sort that the model is trained on
REACH = 120  # characters on either side of a window's middle
STEPS = 60
LEARNING, SHRINK = 0.25, 1.0
PIECE = 1 << 18  # characters that are tagged together
BLOCK = 256  # tokens of a block
BEGIN, INSIDE, OUTSIDE = range(3)
NEVER = -1e4

LENGTHS = np.array([2, 3, 4, 6, 8, 10, 12, 16, 20, 24, 32, 40, 64])
CHANGES = np.array([1, 2, 3, 5, 9])
SHARES = np.array([1e-9, 0.25, 0.5, 0.75, 1.0])
VOWELS = np.array([1e-9, 0.15, 0.3, 0.45])
DENSITY = np.array([1e-9, 0.002, 0.01, 0.03])
LINES = np.array([20, 60, 120, 400])
AROUND = (-3, -2, -1, 1, 2)
N_SIGN, N_LENGTH = 16, len(LENGTHS) + 1


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, where the secret itself starts) of the base patterns."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(0, m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(1, m.start(), m.end(), m.start()) for m in ACCESS.finditer(text)]
    return out + [(2, m.start(), m.end(), m.start()) for m in HEX.finditer(text)]


def file_features(text: str) -> tuple[int, int, int]:
    """Bins of a text: assignments and code signs a character, characters a line."""
    n = max(1, len(text))
    return (int(np.searchsorted(DENSITY, (text.count("=") + text.count(":")) / n, "right")),
            int(np.searchsorted(DENSITY, sum(map(text.count, ";{}()<>")) / n, "right")),
            int(np.searchsorted(LINES, n / (text.count("\n") + 1), "right")))


def _kinds() -> np.ndarray:
    """Bits of a character: blank 1, line break 2, lower 4, upper 8, digit 16, sign 32, vowel 64, hexadecimal 128."""
    out = np.zeros(0x3002, np.uint8)
    for c in range(0x3001):
        x = chr(c)
        if x.isspace():
            out[c] = 3 if x == "\n" else 1
        elif "a" <= x <= "z":
            out[c] = 4 | 64 * (x in "aeiou") | 128 * (x <= "f")
        elif "A" <= x <= "Z":
            out[c] = 8 | 64 * (x in "AEIOU")
        elif "0" <= x <= "9":
            out[c] = 16 | 128
        elif c < 128 and x != "_":
            out[c] = 32
    return out


KIND_OF = _kinds()  # the last entry stands for all other characters


class Tokens:
    """Tokens of texts that are laid end to end: words (letters, digits, ``_``) and single signs."""

    def __init__(self, texts: list[str]):
        self.joined = "\n".join(texts)
        sizes = np.array([len(t) for t in texts])
        self.begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        cp = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = KIND_OF[np.minimum(cp, len(KIND_OF) - 1)]
        word = (kind & 33) == 0
        sign = (kind & 32) > 0
        framed = np.concatenate(([False], word, [False]))
        self.start = np.nonzero(sign | word & ~framed[:-2])[0]
        self.end = np.nonzero(sign | word & ~framed[2:])[0] + 1
        start, end = self.start, self.end

        def count(bit: int) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum((kind & bit) > 0, dtype=np.int32)))
            return total[end] - total[start]

        n = end - start
        lower, upper, digit, signs = (count(b) for b in (4, 8, 16, 32))
        changed = np.concatenate(([0], np.cumsum(np.concatenate(([False], (kind[1:] & 28) != (kind[:-1] & 28))), dtype=np.int32)))
        changes = changed[end] - changed[np.minimum(start + 1, len(changed) - 1)]
        self.line = np.concatenate(([0], np.cumsum((kind & 2) > 0, dtype=np.int32)))[start]
        self.first = np.ones(len(start), bool)
        self.first[1:] = self.line[1:] != self.line[:-1]
        self.sign = (lower > 0) + 2 * (upper > 0) + 4 * (digit > 0) + 8 * (n > lower + upper + digit)
        length = np.searchsorted(LENGTHS, n, "right")
        letters = np.maximum(1, lower + upper)
        self.shape = [
            (length * N_SIGN + self.sign, N_LENGTH * N_SIGN),
            (np.searchsorted(CHANGES, changes, "right") * N_SIGN + self.sign, (len(CHANGES) + 1) * N_SIGN),
            (np.searchsorted(VOWELS, count(64) / letters, "right") * N_LENGTH + length, (len(VOWELS) + 1) * N_LENGTH),
            (np.searchsorted(SHARES, digit / n, "right") * 2 + (count(128) == n), (len(SHARES) + 1) * 2),
            (length * 2 + ((digit > 0) & (lower + upper > 0)), N_LENGTH * 2),
        ]
        # Words (no digits, at most 16 characters, case apart) and signs have a hash of their own.
        power, inverse = _powers(max(12, len(cp).bit_length()))
        value = cp + np.uint32(32) * ((kind & 8) > 0)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value.astype(np.uint64) * power[:len(cp)])))
        h = (total[end] - total[start]) * inverse[np.minimum(start, len(inverse) - 1)] + n.astype(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        self.word = np.where((digit == 0) & (n <= 16), h ^ (h >> np.uint64(29)) | np.uint64(1), np.uint64(0))
        self.is_sign = signs > 0

    def attributes(self, vocabulary: np.ndarray, files: np.ndarray, hidden: int = 0) -> list[tuple[np.ndarray, int]]:
        """(value of every token, number of values) of each attribute; ``hidden`` 1: without words and file,
        2: without the kinds of characters too."""
        v = len(vocabulary)
        at = np.minimum(np.searchsorted(vocabulary, self.word), max(0, v - 1))
        known = (vocabulary[at] == self.word) if v else np.zeros(len(self.word), bool)
        if hidden:
            known &= self.is_sign
        own = np.where(known, at + 1, 0)
        near = np.concatenate((np.where(known, at, v + self.sign), [v + N_SIGN]))  # the last: there is no token
        out = [(np.full_like(a, size) if hidden == 2 and i < 2 else a, size + 1) for i, (a, size) in enumerate(self.shape)]
        out.append((own, v + 1))
        place = np.arange(len(self.start))
        for d in AROUND:
            other = place + d
            inside = (other >= 0) & (other < len(place))
            other = np.where(inside, other, 0)
            other = np.where(inside & (self.line[other] == self.line), other, -1) if len(place) else other
            out.append((near[other], v + N_SIGN + 1))
        doc = np.searchsorted(self.begins, self.start, "right") - 1
        for i, size in enumerate((len(DENSITY) + 1, len(DENSITY) + 1, len(LINES) + 1)):
            out.append((np.full(len(place), size) if hidden else files[doc, i], size + 1))
        return out


def viterbi(unary: np.ndarray, first: np.ndarray, step: np.ndarray, start: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Tags of the best path through all tokens; a ``first`` token starts anew."""
    n = len(unary)
    if not n:
        return np.zeros(0, np.int8)
    m = -(-n // block)
    u = np.zeros((m * block, 3))
    u[:n] = unary
    new = np.ones(m * block, bool)
    new[:n] = first
    u, new = u.reshape(m, block, 3), new.reshape(m, block)
    again = np.broadcast_to(start, (3, 3))
    # best[b, s, j]: of the paths through block b up to the token, entered with tag s and ending in j
    best, back = None, np.zeros((m, block, 3, 3), np.int8)
    for t in range(block):
        moves = np.where(new[:, t, None, None], again, step)
        if t == 0:
            best = moves + u[:, t, None, :]
        else:
            ways = best[:, :, :, None] + moves[:, None, :, :]
            back[:, t] = ways.argmax(2)
            best = ways.max(2) + u[:, t, None, None, :].reshape(m, 1, 3)
    # entered[b]: the tag before block b on the best path to each tag at its end
    score, entered = np.zeros(3), np.zeros((m, 3), np.int8)
    for b in range(m):
        ways = score[:, None] + best[b]
        entered[b] = ways.argmax(0)
        score = ways.max(0)
    last, before = np.zeros(m, np.int8), np.zeros(m, np.int8)
    j = int(score.argmax())
    for b in range(m - 1, -1, -1):
        last[b] = j
        before[b] = j = int(entered[b, j])
    tags, blocks, now = np.zeros((m, block), np.int8), np.arange(m), last
    for t in range(block - 1, -1, -1):
        tags[:, t] = now
        now = back[blocks, t, before, now]
    return tags.ravel()[:n]


def lead_needed(step: np.ndarray, start: np.ndarray) -> float:
    """By how much the tags around a token can at most speak against its being outside, when an inside
    that follows it has to become a begin: over all tags before, of it, after it and after that."""
    into = [*step, start]  # from each tag, or at a line's start
    out = [[*row, 0.0] for row in step]  # to each tag, or at a line's end
    most = 0.0
    for row in into:
        for x in (BEGIN, INSIDE):
            if row[x] <= NEVER / 2:
                continue
            for k in (BEGIN, INSIDE, OUTSIDE, 3):
                then = BEGIN if k == INSIDE else k
                loss = row[x] + out[x][k] - row[OUTSIDE] - out[OUTSIDE][then]
                if k == INSIDE:
                    loss += max(out[INSIDE][z] - out[BEGIN][z] for z in range(4))
                most = max(most, loss)
    return most


def best_tags(unary: np.ndarray, first: np.ndarray, step: np.ndarray, start: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Tags of the best path.  A token that is outside on any best path, whatever its neighbours, parts
    the chain; only what lies between such tokens is decoded."""
    n = len(unary)
    lead = unary[:, OUTSIDE] - np.maximum(unary[:, BEGIN], unary[:, INSIDE])
    change = np.zeros(n)  # what the next token may lose from inside to begin
    change[:-1] = np.where(first[1:], 0, np.maximum(0, unary[1:, INSIDE] - unary[1:, BEGIN]))
    sure = lead > lead_needed(step, start) + change + 1e-6
    tags = np.full(n, OUTSIDE, np.int8)
    open_ = np.nonzero(~sure)[0]
    if len(open_):
        u = unary[open_].copy()
        after = (open_ > 0) & sure[open_ - 1] & ~first[open_]
        follows = np.minimum(open_ + 1, n - 1)
        before = (open_ + 1 < n) & sure[follows] & ~first[follows]
        u[before] += step[:, OUTSIDE]
        u[after] += step[OUTSIDE] - start
        tags[open_] = viterbi(u, first[open_] | after, step, start, block)
    return tags


def spans_of(tags: np.ndarray, tokens: Tokens) -> list[tuple[int, int, int]]:
    """(text, start, end) of the runs of begin and inside, by the text's own offsets."""
    begin = np.nonzero(tags == BEGIN)[0]
    if not len(begin):
        return []
    stop = np.append(np.nonzero((tags != INSIDE) | tokens.first)[0], len(tags))
    final = stop[np.searchsorted(stop, begin, "right")] - 1
    start, end = tokens.start[begin], tokens.end[final]
    doc = np.searchsorted(tokens.begins, start, "right") - 1
    return list(zip(doc.tolist(), (start - tokens.begins[doc]).tolist(), (end - tokens.begins[doc]).tolist()))


class Model:
    """Weights of the attributes' values for each tag, and of the tags' transitions."""

    def __init__(self, vocabulary: np.ndarray, tables: list[np.ndarray], step: np.ndarray, start: np.ndarray):
        self.vocabulary, self.tables, self.step, self.start = vocabulary, tables, step, start

    def tag(self, texts: list[str]) -> list[tuple[int, int, int]]:
        """(text, start, end) of the secrets that the best tags give."""
        tokens = Tokens(texts)
        if not len(tokens.start):
            return []
        files = np.array([file_features(t) for t in texts])
        unary = sum(w[a] for w, (a, _) in zip(self.tables, tokens.attributes(self.vocabulary, files)))
        return spans_of(best_tags(unary, tokens.first, self.step, self.start), tokens)


def expectations(unary: np.ndarray, lengths: np.ndarray, step: np.ndarray, start: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log of the sum over all tags of padded lines (longest first), and how often the model expects
    each tag at each token and each transition."""
    n, longest, _ = unary.shape
    top = unary.max(2, keepdims=True)
    psi, move = np.exp(unary - top), np.exp(step)
    active = [int(np.searchsorted(-lengths, -t, "left")) for t in range(longest)]  # lines longer than t
    ahead, behind, scale = np.zeros_like(psi), np.ones_like(psi), np.ones((n, longest))
    for t in range(longest):
        k = active[t]
        now = (ahead[:k, t - 1] @ move if t else np.exp(start)) * psi[:k, t]
        scale[:k, t] = now.sum(1)
        ahead[:k, t] = now / scale[:k, t, None]
    moves = np.zeros((3, 3))
    for t in range(longest - 1, 0, -1):
        k = active[t]
        after = psi[:k, t] * behind[:k, t] / scale[:k, t, None]
        moves += move * (ahead[:k, t - 1].T @ after)
        behind[:k, t - 1] = after @ move.T
    real = np.arange(longest) < lengths[:, None]
    return float(np.log(scale).sum() + top[real].sum()), ahead * behind, moves


def fit(windows: list[dict], steps: int = STEPS) -> Model:
    """The CRF of windows with ``text``, the ``file``'s features and labelled ``spans``."""
    tokens = Tokens([w["text"] for w in windows])
    words, counts = np.unique(tokens.word[tokens.word > 0], return_counts=True)
    vocabulary = words[counts >= 3]
    files = np.array([w["file"] for w in windows])
    doc = np.searchsorted(tokens.begins, tokens.start, "right") - 1
    tag = np.full(len(tokens.start), OUTSIDE)
    for i, w in enumerate(windows):
        for a, b in w["spans"]:
            inside = slice(*np.searchsorted(tokens.start, [tokens.begins[i] + a, tokens.begins[i] + b]))
            tag[inside] = INSIDE
            tag[inside.start:min(inside.start + 1, inside.stop)] = BEGIN
    # A secret that goes on in another line, or begins within a token, begins with what is left of it.
    tag[(tag == INSIDE) & tokens.first] = BEGIN
    plain, bare, least = (tokens.attributes(vocabulary, files, hidden) for hidden in range(3))
    sizes = [s for _, s in plain]
    offset = np.concatenate(([0], np.cumsum(sizes)))
    marked = np.array([bool(w["spans"]) for w in windows])[doc]
    index = np.concatenate([np.stack([a for a, _ in x], 1)[keep] + offset[:-1] for x, keep in ((plain, slice(None)), (bare, marked), (least, marked))])
    tag = np.concatenate((tag, tag[marked], tag[marked]))
    # Windows are cut at line ends, so a token in ``marked`` has its whole line there.
    first = np.concatenate((tokens.first, tokens.first[marked], tokens.first[marked]))
    line = np.cumsum(first) - 1
    place = np.arange(len(first)) - np.nonzero(first)[0][line]
    lengths = np.bincount(line)
    by_length = np.argsort(-lengths, kind="stable")
    lengths = lengths[by_length]
    line = np.argsort(by_length)[line]
    never_step, never_start = np.zeros((3, 3)), np.zeros(3)
    never_step[OUTSIDE, INSIDE] = never_start[INSIDE] = NEVER
    seen_moves, seen_first = np.zeros((3, 3)), np.bincount(tag[first], minlength=3)
    np.add.at(seen_moves, (tag[:-1][~first[1:]], tag[1:][~first[1:]]), 1)
    truth = np.eye(3)[tag]
    columns = list(np.ascontiguousarray(index.T))
    parts = [np.zeros((offset[-1], 3)), np.zeros((3, 3)), np.zeros(3)]
    moment, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for i in range(1, steps + 1):
        weights, step, start = parts
        unary = np.zeros((len(lengths), lengths[0], 3))
        unary[line, place] = sum(weights[column] for column in columns)
        _, expected, moves = expectations(unary, lengths, step + never_step, start + never_start)
        wrong = expected[line, place] - truth
        slope = np.stack([np.concatenate([np.bincount(c - o, wrong[:, j], z) for c, o, z in zip(columns, offset, sizes)]) for j in range(3)], 1)
        for k, g in enumerate((slope, moves - seen_moves, expected[:, 0].sum(0) - seen_first)):
            g = g + SHRINK * parts[k]
            moment[k] += 0.1 * (g - moment[k])
            square[k] += 0.01 * (g * g - square[k])
            parts[k] = parts[k] - LEARNING * (moment[k] / (1 - 0.9 ** i)) / (np.sqrt(square[k] / (1 - 0.99 ** i)) + 1e-8)
    weights, step, start = parts
    return Model(vocabulary, [weights[a:b] for a, b in zip(offset[:-1], offset[1:])], step + never_step, start + never_start)


def _window(text: str, at: int, reach: int) -> tuple[int, int]:
    """A window around a place, from blank to blank where there are blanks."""
    a, b = max(0, at - reach), min(len(text), at + reach)
    blank = BLANK.search(text, a, at) if a else None
    if blank:
        a = blank.end()
    if b < len(text):
        b = max([m.start() for m in BLANK.finditer(text, at, b)], default=b)
    return a, b


def sample_windows(docs: DataFrame, text: str, sample: int = SAMPLE, reach: int = REACH) -> list[dict]:
    """Of each sort (with a secret, with another token with digits, any) the distinct windows with the
    least content hashes.  A task returns ``sample`` windows of a sort at most."""
    def run(batches):
        import xxhash
        best: list[list] = [[], [], []]
        have: list[set] = [set(), set(), set()]

        def offer(sort: int, x: str, at: int, spans: list, file: tuple) -> None:
            a, b = _window(x, at, reach)
            h = xxhash.xxh3_64_intdigest(x[a:b]) >> 1
            heap = best[sort]
            if h in have[sort] or (len(heap) >= sample and -heap[0][0] <= h):
                return
            own = [(max(s, a) - a, min(e, b) - a) for _, _, e, s in spans if s < b and e > a]
            have[sort].add(h)
            heapq.heappush(heap, (-h, x[a:b], own, file))
            if len(heap) > sample:
                have[sort].discard(-heapq.heappop(heap)[0])

        for batch in batches:
            for x in batch.column(0):
                x = x.as_py()
                if not x:
                    continue
                spans, file = base_spans(x), file_features(x)
                for s in spans:
                    offer(0, x, s[3], spans, file)
                at = xxhash.xxh3_64_intdigest(x) % len(x)
                taken = lambda p: any(s <= p < e for _, s, e, _ in spans)
                if not taken(at):
                    offer(2, x, at, spans, file)
                m = DIGIT.search(x, at) or DIGIT.search(x)
                if m and not taken(m.start()):
                    offer(1, x, m.start(), spans, file)
        rows = [(sort, -h, w, [{"a": a, "b": b} for a, b in own], list(file)) for sort in range(3) for h, w, own, file in best[sort]]
        span = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        kinds = (("sort", pa.int32()), ("h", pa.int64()), ("text", pa.string()), ("spans", span), ("file", pa.list_(pa.int32())))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(kinds)], [n for n, _ in kinds])

    found = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(run, "sort int, h long, text string, spans array<struct<a:int,b:int>>, file array<int>")
    found = written(found, "secret-windows")
    out = []
    for sort in range(3):
        each = found.filter(F.col("sort") == sort).groupBy("h").agg(F.min(F.struct("text", "spans", "file")).alias("w")).orderBy("h").limit(sample)
        out += [{"text": r.w.text, "spans": [(s.a, s.b) for s in r.w.spans], "file": list(r.w.file)} for r in each.collect()]
    return out


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model | None:
    """The CRF of a corpus; none if no text has a base span."""
    windows = sample_windows(docs, text, sample)
    return fit(windows) if any(w["spans"] for w in windows) else None


def secret_spans(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """(kept struct of the ``keep`` columns, base array<struct<start, k, end>>, learned likewise) of every row."""
    kept = F.struct(*[F.col(f"`{k}`") for k in keep]).alias("kept")
    rows = docs.select(kept, F.col(f"`{text}`").alias("t"))
    span = pa.list_(pa.struct([("start", pa.int32()), ("k", pa.int32()), ("end", pa.int32())]))

    def pieces(texts: list[str]):
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= PIECE):
                size += len(texts[end])
                end += 1
            yield at, texts[at:end]
            at = end

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 2048):
                part = batch.slice(begin, 2048)
                texts = [x or "" for x in part.column("t").to_pylist()]
                base = [[{"start": s, "k": k, "end": e} for k, s, e, _ in base_spans(x)] for x in texts]
                learned = [[] for _ in texts]
                for at, some in pieces(texts) if model else ():
                    for i, s, e in model.tag(some):
                        if not any(b["start"] < e and s < b["end"] for b in base[at + i]):
                            learned[at + i].append({"start": s, "k": 3, "end": e})
                yield pa.RecordBatch.from_arrays([part.column("kept"), pa.array(base, span), pa.array(learned, span)], ["kept", "base", "learned"])

    kind = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "k", "end")]))
    return rows.mapInArrow(run, T.StructType([rows.schema["kept"], T.StructField("base", kind), T.StructField("learned", kind)]))


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(k: int):
    return lambda s: s["k"] == k


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = table(spark, sf_dir, "documents")
    found = secret_spans(docs, train(docs))
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("kept.doc_id", *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.concat("base", "learned")).alias("spans"))
