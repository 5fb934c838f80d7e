"""Personal data: patterns, and a character BiLSTM with CRF transitions that adds to them.

Four kinds are found: email, ip, card, phone. The patterns give base spans. The network, trained
in numpy on labelled spans, looks for the forms that patterns miss (phone numbers without a country
code, spelled-out at signs and dots, cards and addresses with odd separators). Texts are cut into
overlapping windows on a fixed grid; the scores of all windows over a character are averaged and each run
of windows is decoded once, by Viterbi, over its whole length. A decoded span is added if it has the
digits its kind needs and overlaps no base span.

A span of any kind holds a digit or an at sign, or has the form of a spelled-out address as a whole (``spelled``).
Every window that touches one of these is scored, and one window on each side; no other can hold a part of a span.

Training: windows around base spans of about ``SAMPLE_DOCS`` documents, taken by hash of the id, labelled by
the patterns, and the same contexts with written-in spans of all forms, labelled by construction.

Defined results: null and empty texts have no spans; repeated rows give repeated results; null ids
are kept; in an empty table the network learns from made-up contexts alone; other columns are ignored. Positions
are code points, ends exclusive.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm.common import batch_of, blocks, mapped, unit_hash

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, kind, end: sorts as results are ordered

# --- base spans ---------------------------------------------------------------------------------

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive runs that begin at the first digit give the same matches without trying every digit anew.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]").search
DIGIT = re.compile(r"[0-9]").search


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at sign and dotted domain; linear in the text."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.fullmatch(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        # Without a domain the next match still cannot begin before this sign.
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(d - 9 if d > 9 else d for d in (2 * int(c) for c in digits[-2::-2]))) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if DIGIT(text):
        for m in IP.finditer(text):
            if all(map(_small, m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() >= 14 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


# --- the network --------------------------------------------------------------------------------

HIDDEN = 16
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
SIZE, STRIDE = 96, 64
SIGNS = "@.-+ ()_%\n/:,[]#='\""
OTHER, WIDE = 1 + 1 + len(SIGNS) + 26, 2 + 1 + len(SIGNS) + 26
ALPHABET = WIDE + 1
SAMPLE_DOCS = 1500
STEPS, BATCH = 300, 64

_ASCII = np.full(128, OTHER, dtype=np.uint8)
_ASCII[48:58] = 1
for _i, _c in enumerate(SIGNS):
    _ASCII[ord(_c)] = 2 + _i
for _i in range(26):
    _ASCII[97 + _i] = _ASCII[65 + _i] = 2 + len(SIGNS) + _i


def codes(text: str) -> np.ndarray:
    """Small numbers for characters: digits alike, letters without case, wide characters alike. 0 is kept for nothing."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.where(points < 128, _ASCII[np.minimum(points, 127)], WIDE).astype(np.uint8)


class Model(NamedTuple):
    look: np.ndarray  # direction, character, gates
    back: np.ndarray  # direction, hidden, gates
    out: np.ndarray  # hidden of both directions, tag
    bias: np.ndarray  # tag
    step: np.ndarray  # tag to tag


def forbidden() -> np.ndarray:
    """A large loss for tag pairs that cannot follow one another: inside only after the same kind."""
    loss = np.zeros((TAGS, TAGS))
    for inside in range(2, TAGS, 2):
        loss[:, inside] = -1e4
        loss[inside - 1, inside] = loss[inside, inside] = 0.0
    return loss


FORBIDDEN = forbidden()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(x: np.ndarray, look: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, list]:
    """One direction over ``x`` (time, window): hidden states and what the gradient needs."""
    h = c = np.zeros((x.shape[1], HIDDEN), dtype=look.dtype)
    states, kept = np.empty((len(x), x.shape[1], HIDDEN), dtype=look.dtype), []
    for t, row in enumerate(x):
        z = look[row] + h @ back
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        old, before = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        states[t] = h
        kept.append((i, f, o, g, old, tc, before))
    return states, kept


def _unroll(x: np.ndarray, kept: list, d_states: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of one direction."""
    dh = dc = np.zeros((x.shape[1], HIDDEN), dtype=back.dtype)
    dz = np.empty((*x.shape, 4 * HIDDEN), dtype=back.dtype)
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, old, tc, _ = kept[t]
        dh = dh + d_states[t]
        dc = dc + dh * o * (1 - tc * tc)
        row = dz[t]
        row[:, :HIDDEN] = dc * g * i * (1 - i)
        row[:, HIDDEN : 2 * HIDDEN] = dc * old * f * (1 - f)
        row[:, 2 * HIDDEN : 3 * HIDDEN] = dh * tc * o * (1 - o)
        row[:, 3 * HIDDEN :] = dc * i * (1 - g * g)
        dh, dc = row @ back.T, dc * f
    flat, by = dz.reshape(-1, 4 * HIDDEN), x.reshape(-1)
    order = np.argsort(by, kind="stable")
    some, first = np.unique(by[order], return_index=True)
    look = np.zeros((ALPHABET, 4 * HIDDEN), dtype=back.dtype)
    look[some] = np.add.reduceat(flat[order], first, axis=0)
    # Plain loops, not threaded products: those stall where other work keeps the cores busy.
    return look, np.einsum("tbh,tbg->hg", np.stack([k[6] for k in kept]), dz)


def emissions(x: np.ndarray, m: Model) -> np.ndarray:
    """Tag scores (window, time, tag) of ``x`` (window, time)."""
    forward, _ = _run(x.T, m.look[0], m.back[0])
    backward, _ = _run(x.T[::-1], m.look[1], m.back[1])
    return (np.concatenate((forward, backward[::-1]), axis=2) @ m.out + m.bias).transpose(1, 0, 2)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _crf(e: np.ndarray, y: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the negative log-likelihood with respect to scores (time, window, tag) and transitions."""
    times, rows, _ = e.shape
    full = step + FORBIDDEN
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0] + FORBIDDEN[0]
    for t in range(1, times):
        alpha[t] = _lse(alpha[t - 1][:, :, None] + full, 1) + e[t]
    for t in range(times - 2, -1, -1):
        beta[t] = _lse(full + (beta[t + 1] + e[t + 1])[:, None, :], 2)
    total = _lse(alpha[-1], 1)
    d_e = np.exp(alpha + beta - total[None, :, None])
    d_e[np.arange(times)[:, None], np.arange(rows), y] -= 1
    pair = np.exp(alpha[:-1][:, :, :, None] + full + (beta[1:] + e[1:])[:, :, None, :] - total[None, :, None, None])
    d_step = pair.sum(axis=(0, 1))
    np.add.at(d_step, (y[:-1], y[1:]), -1)
    return d_e, d_step


def train(windows: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 1) -> Model:
    """Fit to windows of characters with tags, by Adam on random batches."""
    chance = np.random.default_rng(seed)
    shape = {"look": (2, ALPHABET, 4 * HIDDEN), "back": (2, HIDDEN, 4 * HIDDEN), "out": (2 * HIDDEN, TAGS), "bias": (TAGS,), "step": (TAGS, TAGS)}
    p = {k: chance.normal(0, 0.3 if k == "look" else 0.25, s) if k in ("look", "back", "out") else np.zeros(s) for k, s in shape.items()}
    p["look"][:, :, HIDDEN : 2 * HIDDEN] += 1.0  # remember at first
    p = {k: v.astype(np.float32) for k, v in p.items()}
    mean, square = ({k: np.zeros(s) for k, s in shape.items()} for _ in range(2))
    for n in range(1, steps + 1):
        pick = chance.integers(0, len(windows), BATCH)
        x, y = windows[pick].T, tags[pick].T
        forward, kept_f = _run(x, p["look"][0], p["back"][0])
        backward, kept_b = _run(x[::-1], p["look"][1], p["back"][1])
        states = np.concatenate((forward, backward[::-1]), axis=2)
        d_e, d_step = _crf((states @ p["out"] + p["bias"]).astype(np.float64), y, p["step"])
        d_states = d_e.astype(np.float32) @ p["out"].T
        first = _unroll(x, kept_f, d_states[:, :, :HIDDEN], p["back"][0])
        second = _unroll(x[::-1], kept_b, d_states[::-1, :, HIDDEN:], p["back"][1])
        grads = {
            "look": np.stack((first[0], second[0])), "back": np.stack((first[1], second[1])),
            "out": np.einsum("tbh,tbk->hk", states, d_e), "bias": d_e.sum(axis=(0, 1)), "step": d_step,
        }
        rate = 0.02 * (1 - n / (steps + 1))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values())) / BATCH
        for k, g in grads.items():
            g = g / BATCH / max(1.0, norm / 5.0)
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            p[k] -= (rate * (mean[k] / (1 - 0.9**n)) / (np.sqrt(square[k] / (1 - 0.99**n)) + 1e-8)).astype(np.float32)
    p["step"] = p["step"] + FORBIDDEN
    return Model(**{k: v.astype(np.float32) for k, v in p.items()})


def viterbi(e: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best tags (sequence, time) of scores (sequence, time, tag); what lies past a length is meaningless."""
    rows, times, _ = e.shape
    best = e[:, 0] + FORBIDDEN[0].astype(e.dtype)
    came = np.zeros((rows, times, TAGS), dtype=np.int8)
    for t in range(1, times):
        path = best[:, :, None] + step
        came[:, t] = path.argmax(axis=1)
        # Past its end a sequence stays as it is.
        best = np.where((t < lengths)[:, None], path.max(axis=1) + e[:, t], best)
    tags = np.zeros((rows, times), dtype=np.int8)
    now = best.argmax(axis=1)
    index = np.arange(rows)
    for t in range(times - 1, -1, -1):
        inside = t < lengths
        tags[inside, t] = now[inside]
        now = np.where(inside, came[index, t, now], now) if t else now
    return tags


def tag_spans(tags: np.ndarray) -> list[Span]:
    """Runs of begin and inside tags."""
    out, start, kind = [], -1, -1
    for i in np.flatnonzero(np.concatenate((tags != 0, [False])) | np.concatenate(([False], tags != 0))).tolist():
        tag = int(tags[i]) if i < len(tags) else 0
        if start >= 0 and (tag == 0 or tag % 2 == 1):
            out.append((start, kind, i))
            start = -1
        if tag % 2 == 1:
            start, kind = i, tag // 2
    return out


# --- finding --------------------------------------------------------------------------------------

WEIGHT = (1.0 - np.abs(np.arange(SIZE) - (SIZE - 1) / 2) / (SIZE / 2)).astype(np.float32)[:, None] + 0.05
PUNCTUATION = " \n\t,;:.!?'\"<>|"
SPELLED = ((re.compile(r"\s*[\[({]\s*(?:at|@)\s*[\])}]\s*|\s+at\s+|\s*@\s*", re.I), "@"), (re.compile(r"\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*|\s+dot\s+", re.I), "."))
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_LIKE = re.compile(r"[0-9]{1,3}(?:[\s.,:\[\]()]+(?:dot)?[\s.,:\[\]()]*[0-9]{1,3}){3}")
CARD_LIKE = re.compile(r"[0-9](?:[\s.\-_/]{0,2}[0-9])+")
#: Where a span may lie apart from its digits: between those of an address, and in a spelled-out address.
GAP = re.compile(r"(?<=[0-9])[\s.,:\[\]()]++(?:dot[\s.,:\[\]()]*+)?(?=[0-9])")
AT = re.compile(r"[\[({]\s*+(?:at|@)\s*+[\])}]|(?<=\s)at(?=\s)|@", re.I)
_DOT = r"(?:\s*+[\[({]\s*+(?:dot|\.)\s*+[\])}]\s*+|\s++dot\s++)"
_TOD = r"(?:\s*+[\])}]\s*+(?:tod|\.)\s*+[\[({]\s*+|\s++tod\s++)"
AFTER_AT = re.compile(rf"\s*+[a-z0-9-]++(?:(?:\.|{_DOT})[a-z0-9-]++)++", re.I)
BEFORE_AT = re.compile(rf"\s*+[a-z0-9._%+-]++(?:{_TOD}[a-z0-9._%+-]++)*+", re.I)  # read backwards
PHONE_LIKE = re.compile(r"(?:\+|00)?\s?\(?[0-9]{1,4}\)?(?:[\s./-]{1,2}\(?[0-9]{2,5}\)?){1,5}")


def plausible(text: str, kind: int) -> bool:
    """Whether a decoded span has what its kind needs."""
    digits = _digits(text)
    if kind == 0:
        for pattern, sign in SPELLED:
            text = pattern.sub(sign, text)
        return EMAIL.fullmatch(text) is not None
    if kind == 1:
        return IP_LIKE.fullmatch(text) is not None and all(_small(p) for p in re.findall("[0-9]+", text))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits) and CARD_LIKE.fullmatch(text) is not None
    return 10 <= len(digits) <= 15 and PHONE_LIKE.fullmatch(text) is not None


def spelled(text: str) -> Iterator[tuple[int, int]]:
    """Longest stretches that may be an address by any at and dot signs that ``plausible`` takes; linear in the text."""
    done = 0
    for m in AT.finditer(text):
        domain = AFTER_AT.match(text, m.end())
        local = BEFORE_AT.match(text[done : m.start()][::-1]) if domain else None
        if local:
            yield m.start() - local.end(), domain.end()
        done = m.end()


def marked(text: str, x: np.ndarray) -> np.ndarray:
    """Which characters a plausible span may hold, but for signs next to its digits."""
    mark = (x == 1) | (x == 2)
    for m in GAP.finditer(text):
        mark[m.start() : m.end()] = True
    for a, b in spelled(text):
        mark[a:b] = True
    return mark


def decoded_spans(texts: list[str], m: Model) -> list[list[Span]]:
    """For each text what the network finds in it, plausible or not."""
    found: list[list[Span]] = [[] for _ in texts]
    windows, regions = [], []  # region: text, first character, first window, windows
    for n, text in enumerate(texts):
        if not HINT(text) and not AT.search(text):
            continue
        x = codes(text)
        hint = np.concatenate(([0], np.cumsum(marked(text, x))))
        starts = np.arange(0, max(1, len(x) - (SIZE - STRIDE)), STRIDE)
        held = hint[np.minimum(starts + SIZE, len(x))] > hint[starts]
        if not held.any():
            continue
        near = held.copy()
        near[1:] |= held[:-1]
        near[:-1] |= held[1:]
        live = starts[near]
        padded = np.concatenate((x, np.zeros(SIZE, np.uint8)))
        for run in np.split(live, np.flatnonzero(np.diff(live) > STRIDE) + 1):
            regions.append((n, int(run[0]), len(windows), len(run), min(int(run[-1]) + SIZE, len(x)) - int(run[0])))
            windows.extend(padded[s : s + SIZE] for s in run)
    if not windows:
        return found
    score = np.concatenate([emissions(np.stack(windows[i : i + 512]), m) for i in range(0, len(windows), 512)])
    merged = []
    for _, _, first, count, length in regions:
        total = np.zeros((STRIDE * (count - 1) + SIZE, TAGS), dtype=np.float32)
        weight = np.zeros((len(total), 1), dtype=np.float32)
        for k in range(count):
            total[k * STRIDE : k * STRIDE + SIZE] += score[first + k] * WEIGHT
            weight[k * STRIDE : k * STRIDE + SIZE] += WEIGHT
        merged.append((total / weight)[:length])
    # Runs of like length are decoded together.
    like: dict[int, list[int]] = {}
    for i, e in enumerate(merged):
        like.setdefault(max(len(e) - 1, 1).bit_length(), []).append(i)
    for members in like.values():
        for at in range(0, len(members), 256):
            some = members[at : at + 256]
            lengths = np.array([len(merged[i]) for i in some])
            e = np.zeros((len(some), lengths.max(), TAGS), dtype=np.float32)
            for row, i in enumerate(some):
                e[row, : lengths[row]] = merged[i]
            tags = viterbi(e, lengths, m.step)
            for row, i in enumerate(some):
                n, begin = regions[i][:2]
                found[n] += [(begin + a, kind, begin + b) for a, kind, b in tag_spans(tags[row, : lengths[row]])]
    return found


def all_spans(texts: list[str], m: Model) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans and the added ones."""
    out = []
    for text, decoded in zip(texts, decoded_spans(texts, m)):
        base = base_spans(text)
        added: list[Span] = []
        taken = [(a, b) for a, _, b in base]
        for a, kind, b in sorted(decoded):
            while a < b and text[a] in PUNCTUATION:
                a += 1
            while a < b and text[b - 1] in PUNCTUATION:
                b -= 1
            if a < b and plausible(text[a:b], kind) and not any(a < d and c < b for c, d in taken):
                added.append((a, kind, b))
                taken.append((a, b))
        out.append((base, added))
    return out


# --- labelled spans -------------------------------------------------------------------------------

CONTEXT = "the report of last week was sent to all members and they said that it came in on time with some notes"


def _written(kind: int, chance: random.Random) -> str:
    """A made-up span of a kind, in a form that patterns find or one that they miss."""
    digit = lambda n: "".join(chance.choice("0123456789") for _ in range(n))
    word = lambda: "".join(chance.choice("abcdefghiklmnoprstuvwz") for _ in range(chance.randint(2, 8)))
    if kind == 0:
        at = chance.choice(["@"] * 4 + [" @ ", " [at] ", "(at)", " at "])
        dot = chance.choice(["."] * 4 + [" [dot] ", "(dot)", " dot "])
        user = word() + chance.choice(["", ".", "_"]) + chance.choice([digit(2), word(), word() + digit(1)])
        return user + at + word() + chance.choice(["", digit(1)]) + dot + chance.choice(["com", "org", "net", "example.com"])
    if kind == 1:
        parts = [str(chance.randint(0, 255)) for _ in range(4)]
        return chance.choice([".", ".", ".", " . ", "[.]", ". "]).join(parts)
    if kind == 2:
        n = chance.choice([14, 15, 16, 16, 16, 19])
        body = chance.choice("3456") + digit(n - 2)
        full = next(body + d for d in "0123456789" if luhn(body + d))
        sign = chance.choice(["", "", " ", "-", ".", "/", "  "])
        return sign.join(full[i : i + 4] for i in range(0, n, 4))
    area, a, b = digit(3), digit(3), digit(4)
    return chance.choice(
        [f"+{chance.randint(1, 99)} ({area}) {a}-{b}", f"+{chance.randint(1, 99)} {area} {a} {b}", f"+1-{area}-{a}-{b}",
         f"({area}) {a}-{b}", f"{area}-{a}-{b}", f"{area}.{a}.{b}", f"00{chance.randint(1, 99)} {area} {a} {b}", f"({area}) {a} {b}"]
    )


def _decoy(chance: random.Random) -> str:
    """Digits and signs that are no personal data."""
    digit = lambda n: "".join(chance.choice("0123456789") for _ in range(n))
    mixed = lambda n: "".join(chance.choice("0123456789abcdef") for _ in range(n))
    return chance.choice(
        [f"{chance.randint(1900, 2030)}-{digit(2)}-{digit(2)}", f"{digit(2)}:{digit(2)}:{digit(2)}", digit(chance.randint(1, 9)),
         f"{digit(1)}.{digit(2)}.{digit(1)}", f"{digit(3)},{digit(3)},{digit(3)}", mixed(chance.choice([16, 32, 40])),
         mixed(8).upper() + "-" + mixed(4).upper(), f"{digit(3)}.{digit(2)}", "@" + mixed(5), f"{digit(4)} {digit(4)}", "AK" + mixed(16).upper(),
         f'key = "{mixed(24)}"', f"{digit(2)}/{digit(2)}/{digit(4)}", " ".join(digit(2) for _ in range(chance.randint(3, 7)))]
    )


def labelled(texts: list[str], windows: int = 3000, seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Windows of characters with tags: base spans in their own contexts, and written-in spans and decoys."""
    chance = random.Random(seed)
    x, y = np.zeros((windows, SIZE), np.uint8), np.zeros((windows, SIZE), np.int64)
    found = [(i, s) for i, t in enumerate(texts) for s in base_spans(t)]
    plain = [t for t in texts if len(t) > 20] or [CONTEXT]
    for n in range(windows):
        if found and n % 4 == 0:
            i, (a, _, _) = chance.choice(found)
            text, spans = texts[i], base_spans(texts[i])
            cut = max(0, a - chance.randint(0, SIZE // 2))
        else:
            source = chance.choice(plain)
            at = chance.randint(0, max(0, len(source) - SIZE))
            words = re.sub("[0-9@]", "", source[at : at + SIZE]).split(" ")
            text, spans = "", []
            for k, w in enumerate(words):
                if k % 6 == 3 and chance.random() < 0.7:
                    if chance.random() < 0.6:
                        kind = chance.randrange(len(KINDS))
                        new = _written(kind, chance)
                        spans.append((len(text), kind, len(text) + len(new)))
                    else:
                        new = _decoy(chance)
                    text += new + chance.choice([" ", " ", ", ", ". ", "\n"])
                text += w + " "
            cut = chance.randint(0, max(0, len(text) - SIZE))
        row = codes(text[cut : cut + SIZE])
        x[n, : len(row)] = row
        last = -1
        for a, kind, b in spans:
            if a < last:  # of overlapping spans the first is learned
                continue
            last = b
            a, b, whole = a - cut, b - cut, a >= cut
            if b > 0 and a < SIZE and (whole or b > 2):
                y[n, max(a, 0) : b] = 2 + 2 * kind
                if a >= 0:
                    y[n, a] = 1 + 2 * kind
                else:
                    y[n, 0] = 1 + 2 * kind
    return x, y


def learn(docs: DataFrame, sample: int = SAMPLE_DOCS, steps: int = STEPS) -> Model:
    """Train on the contexts of at most about ``sample`` documents with a digit or an at sign."""
    rows = docs.where(F.col("text").rlike("[0-9@]")).select("doc_id", "text")
    total = rows.count()
    taken = rows.where(unit_hash(F.col("doc_id"), F.lit("personal")) < F.lit(sample / max(total, 1)))
    schema = pa.schema([("part", pa.string())])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in blocks(batches):
            parts = []
            for t in texts:
                hit = HINT(t)
                parts.append(t[max(0, hit.start() - 300) : hit.start() + 300])
            yield batch_of(schema, part=parts)

    got = sorted({r["part"] for r in mapped(taken.select("text"), contexts, "part string").toLocalIterator(True)})
    return train(*labelled(got), steps=steps)


FOUND = pa.schema([("doc_id", pa.int64()), *((k, pa.int64()) for k in ("n_email", "n_ip", "n_card", "n_phone", "n_added")), ("base", pa.string()), ("spans", pa.string())])


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, base spans by kind counted, added spans counted, base spans and all spans as text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            both = all_spans(texts, sent.value)
            counts = {f"n_{name}": [sum(s[1] == k for s in base) for base, _ in both] for k, name in enumerate(KINDS)}
            yield batch_of(
                FOUND, doc_id=batch.column("doc_id"), **counts, n_added=[len(added) for _, added in both],
                base=[written(base) for base, _ in both], spans=[written(base + added) for base, added in both],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return mapped(rows, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_added long, base string, spans string"
    )


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one, named after the first."""
    out, done = [], 0
    for a, kind, b in sorted(spans):
        if a >= done:
            out.append(text[done:a])
            out.append(f"<{KINDS[kind].upper()}>")
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns; in ``text`` every span gives way to its kind, ``n_chars`` follows if it is there."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            new = [masked(t, base + added) for t, (base, added) in zip(texts, all_spans(texts, sent.value))]
            old = batch.column("text")
            new = pa.array([n if old[i].is_valid else None for i, n in enumerate(new)], type=batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), new)

    out = mapped(docs, run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op7_lstm_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find(docs, learn(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_added"
    )
