"""Chat formatting by token-level assembly.

Each turn is encoded on its own with a byte-level BPE, so nothing inside a text
can merge with, or turn into, a control id; the reserved ids are spliced between
the encoded segments and exist nowhere else.  In the rendered string a control
string inside a text is broken by a backslash after its first character (one
more backslash where the text already has some there), which can be undone.  The loss mask
is the running sum of "open" and "close" marks of the turns to be learned.

Turns of a conversation are streamed in order through one task that keeps a few hash
states, so a conversation of any length needs bounded memory; encoding happens
before the shuffle, where all rows are spread evenly.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Control strings with their ids above the vocabulary (fixed values of the template).
CONTROL = {"[INST]": 50300, "[/INST]": 50301, "<s>": 50302, "</s>": 50303, "<<SYS>>": 50304, "<</SYS>>": 50305, "<|role|>": 50306, "<|text|>": 50307, "<|end|>": 50308}
#: What opens and closes a turn of each role; any other role is written out between <|role|> and <|text|>.
TURN = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
STRING = {i: s for s, i in CONTROL.items()}
ROLE_OF = {CONTROL[a]: role for role, (a, _) in TURN.items()}
FIRST_RESERVED = min(STRING)

_ESCAPE = re.compile("|".join(rf"{re.escape(s[0])}\\*{re.escape(s[1:])}" for s in CONTROL))
_UNESCAPE = re.compile("|".join(rf"{re.escape(s[0])}\\+{re.escape(s[1:])}" for s in CONTROL))


#: Longer runs without a change between white space and other characters are encoded in pieces of so many characters: tokenisers recurse over a run.
RUN = 1000
_LONG_RUN = re.compile(rf"\s{{{RUN}}}|\S{{{RUN}}}")


def _marks(pattern: re.Pattern, text: str) -> list[int]:
    """Place after the first character of every match; matches may overlap, so each search starts one character after the last match's start."""
    at, found = 0, []
    while m := pattern.search(text, at):
        at = m.start() + 1
        found.append(at)
    return found


def escape(text: str) -> str:
    """Put one backslash after the first character of every control string, however many stand there already."""
    marks = _marks(_ESCAPE, text)
    return "\\".join(text[a:b] for a, b in zip([0, *marks], [*marks, len(text)], strict=True)) if marks else text


def unescape(text: str) -> str:
    marks = _marks(_UNESCAPE, text)
    # the character after each mark is a backslash that goes
    return "".join(text[a:b] for a, b in zip([0, *(m + 1 for m in marks)], [*marks, len(text)], strict=True)) if marks else text


class Codec:
    """Token ids of a turn and back."""

    _cache: dict[str, object] = {}

    def __init__(self, path: str = VOCABULARY):
        if path not in self._cache:
            import tiktoken

            ranks = {}
            with open(path, "rb") as lines:
                for token, rank in map(bytes.split, lines):
                    ranks[base64.b64decode(token)] = int(rank)
            pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self._cache[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.encoding = self._cache[path]

    def encode(self, text: str) -> list[int]:
        cuts = [m.end() for m in _LONG_RUN.finditer(text)]
        if not cuts:
            return self.encoding.encode_ordinary(text)
        return [i for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True) for i in self.encoding.encode_ordinary(text[a:b])]

    def decode(self, ids: list[int]) -> str:
        return self.encoding.decode_bytes(ids).decode("utf-8", errors="replace")

    def turn(self, role: str, text: str) -> list[int]:
        body = self.encode(escape(text))
        if role in TURN:
            opening, closing = TURN[role]
            return [CONTROL[opening], *body, CONTROL[closing]]
        return [CONTROL["<|role|>"], *self.encode(escape(role)), CONTROL["<|text|>"], *body, CONTROL["<|end|>"]]


def loss_mask(ids: np.ndarray) -> np.ndarray:
    """1 for the tokens of assistant turns between their marks: running sum of +1 after '<s>' and -1 at '</s>'."""
    delta = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(delta, np.flatnonzero(ids == CONTROL["<s>"]) + 1, 1)
    np.add.at(delta, np.flatnonzero(ids == CONTROL["</s>"]), -1)
    return np.cumsum(delta)[:-1].astype(np.int8)


def read_back(ids: list[int], mask: list[int], codec: Codec) -> Iterator[tuple[str, str, bool]]:
    """(role, text, learned) of the turns in a token sequence, from the ids and the mask alone."""
    role, body, learned = None, [], False
    naming: list[int] | None = None
    for token, on in zip(ids, mask, strict=True):
        if token in ROLE_OF:
            role, body, learned, naming = ROLE_OF[token], [], False, None
        elif token == CONTROL["<|role|>"]:
            role, naming = None, []
        elif token == CONTROL["<|text|>"]:
            role, body, learned = unescape(codec.decode(naming or [])), [], False
            naming = None
        elif token >= FIRST_RESERVED:
            # an empty assistant text has no token under the mask but is learned all the same: its marks say so
            yield role, unescape(codec.decode(body)), learned or token == CONTROL["</s>"]
        elif naming is not None:
            naming.append(token)
        else:
            body.append(token)
            learned = learned or bool(on)


def render(ids: list[int], codec: Codec) -> str:
    out, run = [], []
    for token in ids:
        if token >= FIRST_RESERVED:
            out += [codec.decode(run), STRING[token]]
            run = []
        else:
            run.append(token)
    return "".join([*out, codec.decode(run)])


ENCODED = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("loss_mask", T.ArrayType(T.ByteType())), T.StructField("formatted", T.StringType())])


def _whole(numbers) -> pd.api.extensions.ExtensionArray:
    """Whole numbers, or their digits, where some may be missing."""
    return pd.array([None if x is None else int(x) for x in numbers], dtype="Int64")


def _digests(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=DIGEST.names).assign(conv_id=_whole([r[0] for r in rows]))


def format_turns(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Token ids, loss mask and rendered string of every turn of (conv_id, turn, role, text).

    A null text is empty; a null role is the empty role.  The sequence of a
    conversation is its turns' sequences one after the other, by turn, then role, then text; repeated rows
    are repeated turns.  Rows without a conv_id form one conversation of their own.
    """

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(vocabulary)
        for f in frames:
            ids, masks, strings = [], [], []
            for role, text in zip(f["role"], f["text"], strict=True):
                one = codec.turn(role or "", text or "")
                ids.append(one)
                masks.append(loss_mask(np.array(one, dtype=np.int64)))
                strings.append(render(one, codec))
            yield pd.DataFrame({"conv_id": _whole(f["conv_text"]), "turn": _whole(f["turn_text"]), "role": f["role"], "token_ids": ids, "loss_mask": masks, "formatted": strings})

    # numbers travel as text: a batch with a null would make them floating
    plain = turns.select(F.col("conv_id").cast("long").cast("string").alias("conv_text"), F.col("turn").cast("long").cast("string").alias("turn_text"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInPandas(encode, ENCODED)


DIGEST = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("loss_tokens", T.LongType())])


def digest(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per conversation, all of it read back from token ids and masks."""

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(vocabulary)
        state, rows = None, []

        def close() -> None:
            if state:
                rows.append((state["id"], state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["formatted"], state["tokens"], state["on"]))

        for f in frames:
            for conv, ids, mask, string in zip(f["conv_json"], f["token_ids"], f["loss_mask"], f["formatted"], strict=True):
                if state is None or state["key"] != conv:
                    close()
                    state = {"key": conv, "id": json.loads(conv), "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0, "tokens": 0, "on": 0}
                for role, text, learned in read_back(list(ids), list(mask), codec):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                    if learned:
                        state["chars"] += len(text)
                        state["loss"].update(text.encode())
                state["formatted"] += len(string)
                state["tokens"] += len(ids)
                state["on"] += int(np.sum(mask))
            if rows:
                yield _digests(rows)
                rows = []
        close()
        if rows:
            yield _digests(rows)

    # ids travel as text so that a null id stays apart from every number
    keyed = encoded.withColumn("conv_json", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    dealt = keyed.repartition("conv_json").sortWithinPartitions("conv_json", "turn", "role", "formatted")
    return dealt.select("conv_json", "token_ids", "loss_mask", "formatted").mapInPandas(walk, DIGEST)


def op5_chat_format(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("p")).select("p.*")
    return digest(format_turns(turns.unionByName(probe))).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
