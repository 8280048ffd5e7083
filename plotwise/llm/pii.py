"""Personal data in texts: exact base patterns, and a linear-chain conditional random field for what they leave out.

The field labels the tokens of a sentence with ``o`` or a kind. It sees word shapes only (classes and counts of
characters, separators, a few trigger words, the neighbours' shapes), is trained by gradient steps on the labelled
sentences below, and is decoded by Viterbi for all sentences of a batch side by side. It finds, say, telephone numbers
without a country code and addresses written out; spans of the base patterns are never changed by it.
"""

from __future__ import annotations


import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import LOWER, byte_table, chunks, span_hashes, text_buffer, words_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("o", *KINDS)
#: Text bytes labelled at once: tokens and their features take about 60 times as much.
TEXT_BYTES = 1 << 20

# ---- base patterns -----------------------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then by kind; each pattern's leftmost matches, without those that fail its test.

    The patterns are matched in one pass each, also where a plain search would try every start of a long run again.
    """
    found = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end(), "email"))
            last = match.end()
        at = text.find("@", at + 1)
    if _DIGIT.search(text):
        for match in _CHAIN.finditer(text):
            parts, start = match.group().split("."), match.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                end = start + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                    found.append((start, end, "ip"))
                start = end + 1
        for match in _CARD.finditer(text):
            digits = match.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), match.end(), "card"))
        if "+" in text:
            for match in _PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in match.group()) <= 15:
                    found.append((match.start(), match.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# ---- labelled sentences ------------------------------------------------------------------------------------------

# Fixed values: [kind:text] marks personal data, everything else is not.
LABELLED = """
Call me at [phone:(504) 555-2652] after noon .
Her number is [phone:504-555-0192] , ask for Ann .
Tel [phone:0171 555 2652] or come by .
phone : [phone:(212) 555-0147]
Fax [phone:212.555.0199] , office hours only .
Ring [phone:(030) 555 1234] tomorrow
the line [phone:+49 30 5551 2345] is busy
reach us under [phone:+1 (017) 555-7713] today
Llame al [phone:(911) 555-0101] por favor
Appelez le [phone:01 55 50 12 34] ce soir
Telefon [phone:089-5550-123] ab neun Uhr
and her mobile , [phone:(646) 555-0188] , was off
text [phone:917-555-0133] now
Write to [email:ann.lee@mail.example.com] for details .
mail [email:34@mail7.example.com] or wait
Contact [email:joe (at) mail (dot) com] please
his address is [email:mia at example dot org] he said
send it to [email:info [at] example [dot] net] soon
email : [email:sales@example.co.uk]
Escriba a [email:ana@correo.es] hoy
the server [ip:192.168.10.24] did not answer
from [ip:57.17.173.20] , port open
ping [ip:10.0.0.1] first
IP [ip:233.254.104.120] was blocked .
card [card:4111111111111111] was charged
pay with [card:5500 0000 0000 0004] today
Karte [card:4012-8888-8888-1881] gesperrt
number [card:378282246310005] on file
Licensed under CC BY-NC 4.0.
General Public License , version 3.
In 1998 , 25 of 120 houses were sold for 3,500 dollars .
On 2021-05-17 the price was 12.50 and rose to 13.75 .
token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" here
the id 4041894974608794 is not a card
order 9807915762804491 left the depot
See section 3.2.1 on page 45 .
Version 10.4.2 was released in May 2019 .
the room 404 at the end of the hall
between 10-12 and 14-16 people came
He scored 3-2 , 4-1 and 2-0 .
chapter 12 verses 3-9
total 1000000 units , 99% of them new
look at the dot on the map
we met at noon at the gate
the cat sat on the mat .
The quick brown fox jumps over the lazy dog .
Un de do un ta que la casa en el monte
Die Katze sitzt auf der Matte und schläft .
Le chat est sur la table et dort .
it's 5 o'clock , 20 minutes late
the 90's were better than the 80's
A4 paper , 80 g , 500 sheets
born 12/05/1987 in Lyon , 3rd child
ISBN 978-3-16-148410-0 in print
at 10:45 the train ( 7 min late ) left
$$$ the&&& end*** of### it%%%
x = 3.14159 and y = 2.71828
1 2 3 4 5 6 7 8 9 10 11 12
Bus 42 , stop 17 , 250 m
1990 - 1995 , 2000 - 2005
""".strip().split("\n")


# ---- tokens and their shapes -------------------------------------------------------------------------------------

_SOLID = byte_table(lambda b: b not in b" \t\n\x0b\x0c\r")
_DIGITS = byte_table(lambda b: chr(b).isdigit() and b < 128)
_UPPER = byte_table(lambda b: 65 <= b <= 90)
_LETTER = byte_table(lambda b: b >= 0x80 or chr(b).isalpha())
_LINE = byte_table(lambda b: b == 10)
_STOP = byte_table(lambda b: b in b".!?")
# Words that stand beside personal data or spell its marks.
_TRIGGERS = (
    "at dot (at) (dot) [at] [dot] phone tel tel. telefon fax call ring text mobile number line mail email e-mail address contact write send "
    "ip server ping port from card karte pay isbn id order version section page chapter license"
).split()


def _hashes(words: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return span_hashes(raw, ends - [len(w) for w in words], ends)


_TRIGGER_HASH = _hashes([w.encode() for w in _TRIGGERS])
_TRIGGER_ORDER = np.argsort(_TRIGGER_HASH)


def _bucket(x: np.ndarray, edges: list[int]) -> np.ndarray:
    return np.searchsorted(edges, x, side="right")


class Tokens:
    """Tokens (runs without white space) of texts with their features; a sentence ends with a line or a full stop."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray):
        self.raw = raw
        self.starts, self.ends, at = words_of(raw, bounds, _SOLID)
        n = len(self.starts)
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(at))
        if not n:
            self.features, self.first = np.zeros((0, 0), np.int64), np.zeros(0, np.int64)
            return

        def count(flags: np.ndarray) -> np.ndarray:
            total = np.append(0, np.cumsum(flags, dtype=np.int32))
            return total[self.ends] - total[self.starts]

        digit, letter = _DIGITS[raw], _LETTER[raw]
        runs = digit.copy()
        runs[1:] &= ~digit[:-1]
        n_digits, n_letters, size = count(digit), count(letter), self.ends - self.starts
        n_runs = count(runs) + (digit[self.starts] & ~runs[self.starts])
        head, tail = raw[self.starts], raw[self.ends - 1]
        low = np.frombuffer(LOWER, np.uint8)[raw]
        h = span_hashes(low, self.starts, self.ends)
        place = np.minimum(np.searchsorted(_TRIGGER_HASH[_TRIGGER_ORDER], h), len(_TRIGGERS) - 1)
        trigger = np.where(_TRIGGER_HASH[_TRIGGER_ORDER][place] == h, place + 1, 0)
        marks = {m: np.minimum(count(raw == ord(m)), 4) for m in "@.-()"}
        other = np.minimum(size - n_digits - n_letters - sum(count(raw == ord(m)) for m in "@.-()+,:"), 2)
        valid = np.zeros(n, np.int64)
        for i in np.flatnonzero((n_digits >= 12) & (n_digits <= 19) & (n_letters == 0)).tolist():
            valid[i] = 1 + luhn(re.sub(rb"[^0-9]", b"", raw[self.starts[i] : self.ends[i]].tobytes()).decode())
        kind_of = np.select([_DIGITS[head], _UPPER[head], letter[self.starts]], [0, 1, 2], 3) * 4 + np.select([_DIGITS[tail], _UPPER[tail], letter[self.ends - 1]], [0, 1, 2], 3)
        own = [
            _bucket(n_digits, [1, 2, 3, 4, 5, 7, 10, 12, 17, 20]), _bucket(n_letters, [1, 3, 9]), _bucket(n_runs, [1, 2, 3, 4, 5]), marks["@"], marks["."], marks["-"],
            marks["("] * 5 + marks[")"], (head == ord("+")).astype(np.int64), other, kind_of, trigger, valid,
        ]
        # a sentence begins with a text, behind a line end, or behind a token that ends with a stop
        line = np.append(0, np.cumsum(_LINE[raw]))
        begins = np.ones(n, bool)
        begins[1:] = (self.text[1:] != self.text[:-1]) | (line[self.starts[1:]] != line[self.ends[:-1]]) | (_STOP[tail[:-1]] & (n_digits[:-1] == 0) & (n_letters[:-1] > 2))
        self.first = np.flatnonzero(begins)
        shape = np.minimum(own[0], 7) * 4 + (n_letters > 0) * 2 + (marks["("] > 0)
        beside = []
        for step in (1, -1):
            for values, absent in ((shape, 40), (trigger, len(_TRIGGERS) + 1)):
                moved = np.full(n, absent)
                if step == 1:
                    moved[1:] = np.where(begins[1:], absent, values[:-1])
                else:
                    moved[:-1] = np.where(begins[1:], absent, values[1:])
                beside.append(moved)
        self.features = np.stack([*own, *beside], axis=1) + _OFFSETS


_SIZES = [11, 4, 6, 5, 5, 5, 25, 2, 3, 16, len(_TRIGGERS) + 1, 3, 41, len(_TRIGGERS) + 2, 41, len(_TRIGGERS) + 2]
_OFFSETS = np.append(0, np.cumsum(_SIZES[:-1]))


class Field:
    """The conditional random field: a weight for each feature value and label, and for each two labels in a row."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), len(LABELS)))
        for column in features.T:
            out += self.emit[column]
        return out

    def decode(self, tokens: Tokens) -> np.ndarray:
        """The best label of every token, sentences side by side (ties: the first label)."""
        n = len(tokens.starts)
        labels = np.zeros(n, np.int64)
        if not n:
            return labels
        sizes = np.diff(np.append(tokens.first, n))
        order = np.argsort(-sizes, kind="stable")
        first, sizes = tokens.first[order], sizes[order]
        emit = self.emissions(tokens.features)
        score = emit[first]
        back = np.zeros((n, len(LABELS)), np.int8)
        last_score = np.empty_like(score)
        last_score[:] = score
        for t in range(1, int(sizes[0])):
            active = int(np.searchsorted(-sizes, -t, side="left"))
            ways = last_score[:active, :, None] + self.move[None]
            best = ways.argmax(axis=1)
            back[first[:active] + t] = best
            last_score[:active] = np.take_along_axis(ways, best[:, None, :], axis=1)[:, 0] + emit[first[:active] + t]
        now = last_score.argmax(axis=1)
        for t in range(int(sizes[0]) - 1, -1, -1):
            active = int(np.searchsorted(-sizes, -t, side="left"))
            at = first[:active] + t
            labels[at] = now[:active]
            now[:active] = back[at, now[:active]]
        return labels


def train(labelled: list[str] = LABELLED, rounds: int = 400, decay: float = 0.02) -> Field:
    """Maximise the likelihood of the labelled sentences (with a quadratic penalty) by Adam; always the same result."""
    plain, gold = [], []
    for line in labelled:
        text, spans = "", []
        for piece in re.split(r"(\[(?:email|ip|card|phone):(?:[^\[\]]|\[[a-z]+\])*\])", line):
            match = re.fullmatch(r"\[(email|ip|card|phone):(.*)\]", piece)
            if match:
                spans.append((len(text.encode()), len((text + match[2]).encode()), LABELS.index(match[1])))
                text += match[2]
            else:
                text += piece
        plain.append(text.encode())
        gold.append(spans)
    bounds = np.append(0, np.cumsum([len(p) for p in plain]))
    tokens = Tokens(np.frombuffer(b"".join(plain), np.uint8), bounds)
    truth = np.zeros(len(tokens.starts), np.int64)
    for i, (start, text) in enumerate(zip(tokens.starts, tokens.text)):
        for a, b, label in gold[text]:
            if a <= start - bounds[text] < b:
                truth[i] = label
    k, n = len(LABELS), len(truth)
    sizes = np.diff(np.append(tokens.first, n))
    width = int(sizes.max())
    place = tokens.first[:, None] + np.minimum(np.arange(width)[None], sizes[:, None] - 1)
    here = np.arange(width)[None] < sizes[:, None]
    emit, move = np.zeros((sum(_SIZES), k)), np.zeros((k, k))
    moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(move), np.zeros_like(move)]
    begins = np.zeros(n, bool)
    begins[tokens.first] = True
    inner = np.flatnonzero(~begins)
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[inner - 1], truth[inner]), 1)
    for step in range(1, rounds + 1):
        e = Field(emit, move).emissions(tokens.features)[place]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, width):
            flow = np.logaddexp.reduce(alpha[:, t - 1, :, None] + move[None], axis=1) + e[:, t]
            alpha[:, t] = np.where(here[:, t, None], flow, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            flow = np.logaddexp.reduce(move[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(here[:, t + 1, None], flow, 0.0)
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        post = np.exp(alpha + beta - total[:, None, None])
        wrong = -post[here]  # in token order, as rows of a sentence follow each other
        wrong[np.arange(n), truth] += 1
        grad_emit = np.zeros_like(emit)
        for column in tokens.features.T:
            np.add.at(grad_emit, column, wrong)
        pair = alpha[:, :-1, :, None] + move[None, None] + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
        grad_move = seen - np.exp(pair)[here[:, 1:]].sum(axis=0)
        for i, (w, g) in enumerate(((emit, grad_emit), (move, grad_move))):
            g = g - decay * w
            m, v = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(emit, move)


_TRIM_LEFT, _TRIM_RIGHT = " \t\n\r\x0b\x0c.,;:!?\"'*#$%&<>{}=|", " \t\n\r\x0b\x0c.,;:!?\"'(*#$%&<>{}=|"


def _plausible(kind: str, text: str) -> bool:
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "phone":
        return 7 <= len(digits) <= 15 and not re.search(r"[^0-9 ()+./\-]", text)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9 \-]", text)
    if kind == "ip":
        return re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?", text) is not None
    return re.fullmatch(r"[A-Za-z0-9._%+-]+ ?(?:@|[(\[]?\bat\b[)\]]?) ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[]?\bdot\b[)\]]?) ?[A-Za-z0-9-]+)+", text) is not None


def found_spans(texts: pa.Array, field: Field) -> tuple[list[list[tuple[int, int, str]]], list[list[tuple[int, int, str]]]]:
    """Base spans and all spans of each text; a span of the field is added where it is plausible and meets no base span."""
    plain = [t or "" for t in texts.to_pylist()]
    base = [base_spans(t) for t in plain]
    every = [list(s) for s in base]
    raw, bounds = text_buffer(texts)
    tokens = Tokens(raw, bounds)
    labels = field.decode(tokens)
    marked = np.flatnonzero(labels)
    if len(marked):
        begins = np.zeros(len(labels) + 1, bool)
        begins[tokens.first] = True
        new = np.append(True, (np.diff(marked) > 1) | (labels[marked[1:]] != labels[marked[:-1]]) | begins[marked[1:]])
        group_first = marked[new]
        group_last = marked[np.append(np.flatnonzero(new)[1:] - 1, len(marked) - 1)]
        for a, b in zip(group_first.tolist(), group_last.tolist()):
            i, kind = int(tokens.text[a]), LABELS[labels[a]]
            offset = int(bounds[i])
            start = len(raw[offset : int(tokens.starts[a])].tobytes().decode())
            piece = raw[int(tokens.starts[a]) : int(tokens.ends[b])].tobytes().decode()
            start += len(piece) - len(piece.lstrip(_TRIM_LEFT))
            piece = piece.lstrip(_TRIM_LEFT).rstrip(_TRIM_RIGHT)
            end = start + len(piece)
            if _plausible(kind, piece) and all(e <= start or s >= end for s, e, _ in base[i]):
                every[i].append((start, end, kind))
    return base, [sorted(s, key=lambda x: (x[0], KINDS.index(x[2]))) for s in every]


def said(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base spans by kind, base (kind:start:end, comma-joined) and spans (base and added ones).

    Null text is empty and has none. Repeated rows are searched each, null ids stay, an empty table gives no row; only
    the id and the text are read.
    """
    own = docs.sparkSession.sparkContext.broadcast(field or train())

    def run(batches):
        for batch in chunks(batches, "text", TEXT_BYTES):
            base, every = found_spans(batch.column("text"), own.value)
            counts = [[sum(s[2] == kind for s in spans) for spans in base] for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(map(said, base), pa.string()), pa.array(map(said, every), pa.string())],
                ["doc_id", *[f"n_{kind}" for kind in KINDS], "base", "spans"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span (in order; those inside an earlier one add nothing) replaced by its kind, like <EMAIL>."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def without_personal_data(docs: DataFrame, field: Field | None = None, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All documents with their columns; personal data in the text is masked, and the length (if there is such a column) follows. Null text stays null."""
    own = docs.sparkSession.sparkContext.broadcast(field or train())
    schema = docs.schema

    def run(batches):
        for batch in chunks(batches, text_col, TEXT_BYTES):
            texts = batch.column(text_col)
            _, every = found_spans(texts, own.value)
            new = [t if t is None or not s else masked(t, s) for t, s in zip(texts.to_pylist(), every)]
            batch = batch.set_column(batch.schema.get_field_index(text_col), batch.schema.field(text_col), pa.array(new, texts.type))
            at = batch.schema.get_field_index(length_col)
            if at >= 0:
                changed = np.array([bool(s) for s in every])
                lengths = [len(t) if c and t is not None else n for t, c, n in zip(new, changed, batch.column(at).to_pylist())]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(lengths, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(run, schema)


