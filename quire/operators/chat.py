"""Chat rows → masked, fixed-length fine-tuning examples.

Messages are ``array<struct<role:string, content:string>>`` throughout. All
normalization, rendering, masking, padding and windowing are higher-order array
functions, so a chat build is one narrow projection per row plus one bucketed rank
for the val/train split — no Python in the hot path for the byte tokenizer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.config import BOS_ID, EOS_ID, IGNORE_INDEX, PAD_ID, ChatConfig
from quire.functions.hashing import hex_bucket, order_key
from quire.functions.text import PY_WHITESPACE, col_of, has_content, py_strip
from quire.plans.prefix import bucketed_rank

MESSAGE_TYPE = "array<struct<role:string,content:string>>"
IDS_TYPE = "array<int>"


# ---------------------------------------------------------------- layouts


def _message(role: Column | str, content: Column) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.alias("role"), content.alias("content"))


def flatten_content_parts(parts: Column) -> Column:
    """Content given as ``array<struct<text>>``: non-empty texts joined by newline."""
    texts = F.transform(parts, lambda p: p["text"])
    return F.array_join(F.filter(texts, lambda t: t.isNotNull() & (t != F.lit(""))), "\n")


def normalize_messages(messages: str | Column, parts: bool = False) -> Column:
    """Keep messages with a role and non-blank content; content stripped; order kept.
    With ``parts=True`` the content is a list of ``{text}`` parts."""
    msgs = col_of(messages)
    if parts:
        msgs = F.transform(msgs, lambda m: _message(m["role"], flatten_content_parts(m["content"])))
    kept = F.filter(msgs, lambda m: m["role"].isNotNull() & m["content"].isNotNull() & (py_strip(m["content"]) != F.lit("")))
    return F.transform(kept, lambda m: _message(m["role"], py_strip(m["content"]))).cast(MESSAGE_TYPE)


def normalize_mixed_messages(messages: str | Column) -> Column:
    """Messages as a variant whose contents may be a string or a list of ``{text}`` parts, in one
    column and even in one dialog. Each message is dispatched by what it holds: only objects
    with a string role and a string or a list as content count, only objects among the parts,
    and only strings as their texts. Null where the value isn't a list."""
    of = col_of(messages)
    is_a = lambda v, kind: F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))
    items = lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))
    text = lambda v: F.when(is_a(v, "STRING"), F.try_variant_get(v, "$", "string"))

    def content(m):
        c = F.try_variant_get(m, "$.content", "variant")
        parts = F.transform(items(c), lambda p: F.struct(text(F.try_variant_get(p, "$.text", "variant")).alias("text")))
        return F.when(is_a(c, "ARRAY"), flatten_content_parts(parts)).otherwise(text(c))

    read = F.transform(items(of), lambda m: _message(text(F.try_variant_get(m, "$.role", "variant")), content(m)))
    return F.when(is_a(of, "ARRAY"), normalize_messages(read))


def normalize_prompt_response(prompt: str | Column, response: str | Column, system_prompt: str | None = None) -> Column:
    """Optional system prompt, then user prompt, then assistant response (all stripped)."""
    msgs = []
    if system_prompt is not None and system_prompt.strip():
        msgs.append(_message("system", F.lit(system_prompt.strip())))
    msgs.append(_message("user", py_strip(col_of(prompt))))
    msgs.append(_message("assistant", py_strip(col_of(response))))
    return F.array(*msgs).cast(MESSAGE_TYPE)


def normalize_alpaca(instruction: str | Column, input_text: str | Column, output: str | Column) -> Column:
    """User turn = instruction, plus a blank line and the input when it is non-blank;
    assistant turn = output."""
    ins = py_strip(col_of(instruction))
    inp = py_strip(col_of(input_text))
    prompt = F.when(inp.isNotNull() & (inp != F.lit("")), F.concat(ins, F.lit("\n\n"), inp)).otherwise(ins)
    return F.array(_message("user", prompt), _message("assistant", py_strip(col_of(output)))).cast(MESSAGE_TYPE)


def _list_reason(df: DataFrame, config: ChatConfig, content: str) -> Column:
    name = config.messages_field
    if name not in df.columns:
        return F.lit(f"no field {name}")
    t = df.schema[name].dataType
    if not isinstance(t, T.ArrayType) or not isinstance(t.elementType, T.StructType):
        return F.lit("messages field is not a list")
    kinds = {f.name: f.dataType.simpleString() for f in t.elementType.fields}
    if kinds.get("role") != "string" or not kinds.get("content", "").startswith(content):
        return F.lit(f"messages need a string role and a content of type {content}")
    return F.when(F.col(name).isNull(), F.lit("messages field is missing"))


def _fields_reason(df: DataFrame, *names: str) -> Column:
    types = dict(df.dtypes)
    for f in names:
        if types.get(f) != "string":
            return F.lit(f"field {f} is not a string")
    return F.when(F.greatest(*[F.col(f).isNull() for f in names], F.lit(False)), F.lit(f"field {'/'.join(names)} is missing"))


def validation_reason(df: DataFrame, config: ChatConfig) -> Column:
    """Why a raw row cannot be turned into messages (null when it can): the check that the
    configured layout registered."""
    if config.format not in FORMATS:
        return F.lit(f"unsupported format {config.format}")
    check = CHECKS.get(config.format)
    return check(df, config) if check else F.lit(None).cast("string")


def validate_chat_rows(df: DataFrame, config: ChatConfig, policy: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Split raw rows into (valid, quarantined-with-reason). ``fail`` makes any invalid
    row abort the job when the valid side is computed (``raise_error``), as the
    original job did; ``quarantine`` keeps them aside."""
    reason = validation_reason(df, config)
    tagged = df.withColumn("__reason", reason)
    bad = tagged.where(F.col("__reason").isNotNull()).withColumnRenamed("__reason", "reason")
    if policy == "fail":
        # The error is part of the predicate, so Catalyst cannot prune it away.
        keep = F.col("__reason").isNull() | F.raise_error(F.col("__reason")).isNull()
    elif policy == "quarantine":
        keep = F.col("__reason").isNull()
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return tagged.where(keep).drop("__reason"), bad


FORMATS: dict[str, Callable[[ChatConfig], Column]] = {
    "messages": lambda c: normalize_messages(c.messages_field),
    "messages_parts": lambda c: normalize_messages(c.messages_field, parts=True),
    "prompt_response": lambda c: normalize_prompt_response(c.prompt_field, c.response_field, c.system_prompt),
    "alpaca": lambda c: normalize_alpaca(c.instruction_field, c.input_field, c.output_field),
}


CHECKS: dict[str, Callable[[DataFrame, ChatConfig], Column]] = {
    "messages": lambda df, c: _list_reason(df, c, "string"),
    "messages_parts": lambda df, c: _list_reason(df, c, "array<struct<"),
    "prompt_response": lambda df, c: _fields_reason(df, c.prompt_field, c.response_field),
    "alpaca": lambda df, c: _fields_reason(df, c.instruction_field, c.output_field),
}


def register_chat_format(name: str, build: Callable[[ChatConfig], Column], check: Callable[[DataFrame, ChatConfig], Column] | None = None) -> None:
    """Add a chat layout: ``build(config)`` returns a messages Column; ``check(df, config)``
    a Column with the reason why a row is invalid, null if it isn't (without one every row
    is taken)."""
    FORMATS[name] = build
    CHECKS.pop(name, None)
    if check is not None:
        CHECKS[name] = check


def to_messages(df: DataFrame, config: ChatConfig) -> DataFrame:
    if config.format not in FORMATS:
        raise ValueError(f"Unsupported chat format: {config.format}")
    return df.withColumn("messages", FORMATS[config.format](config))


def drop_empty_dialogs(df: DataFrame, col: str = "messages") -> DataFrame:
    return df.where(F.size(col) > 0)


def assemble_dialogs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Row-per-turn table → one row per dialog with its ordered message list.

    The group is one dialog, so its size is bounded by the dialog itself."""
    packed = turns.groupBy(conv).agg(
        F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("r"), F.col(text).alias("c")))).alias("__m")
    )
    msgs = F.transform(F.col("__m"), lambda m: F.struct(m["r"].alias("role"), m["c"].alias("content")))
    return packed.select(F.col(conv), msgs.cast(MESSAGE_TYPE).alias("messages"))


# ---------------------------------------------------------------- rendering and tokens


def role_tag(role: Column) -> Column:
    return F.lower(F.btrim(role, F.lit(PY_WHITESPACE)))


def render_message(m: Column) -> Column:
    """``<|role|>\\n{content}\\n``."""
    return F.concat(F.lit("<|"), role_tag(m["role"]), F.lit("|>\n"), py_strip(m["content"]), F.lit("\n"))


def render_chat(messages: str | Column) -> Column:
    """The whole dialog as text (messages with blank content skipped)."""
    kept = F.filter(col_of(messages), lambda m: py_strip(m["content"]) != F.lit(""))
    return F.array_join(F.transform(kept, render_message), "")


def _byte_encode_many(texts: Column) -> Column:
    from quire.functions.tokenizers import ByteTokenizer

    return ByteTokenizer().encode_many(texts)


def header_text(m: Column) -> Column:
    return F.concat(F.lit("<|"), role_tag(m["role"]), F.lit("|>\n"))


def mask_labels(
    messages: str | Column,
    encode_many: Callable[[Column], Column] = _byte_encode_many,
    label_alignment: str = "next_token",
    supervise_header: bool = True,
) -> Column:
    """``struct<input_ids, labels>``: ``[bos] + pieces + [eos]``; assistant pieces keep
    their ids, everything else is -100; bos is -100, eos is always supervised.

    Messages are rendered with Catalyst string functions and the dialog's whole piece
    list is encoded by one vectorized call (``encode_many``: ``array<string>`` →
    ``array<array<int>>``, the byte tokenizer by default); masking then works per
    message (``zip_with``), never per token.

    ``label_alignment='same_position'`` keeps labels aligned with the inputs (what the
    original code wrote); ``'next_token'`` (default) moves them one to the left so
    position i is trained to predict token i+1, as documented.
    ``supervise_header=False`` masks the ``<|assistant|>\\n`` header too."""
    kept = F.filter(col_of(messages), lambda m: py_strip(m["content"]) != F.lit(""))
    pieces = encode_many(F.transform(kept, render_message))
    sups = F.transform(kept, lambda m: role_tag(m["role"]) == F.lit("assistant"))
    ids = F.concat(F.array(F.lit(BOS_ID)), F.flatten(pieces), F.array(F.lit(EOS_ID)))

    def masked(p: Column) -> Column:
        return F.array_repeat(F.lit(IGNORE_INDEX), F.size(p))

    if supervise_header:
        lab_pieces = F.zip_with(pieces, sups, lambda p, s: F.when(s, p).otherwise(masked(p)))
    else:
        hdr = F.transform(encode_many(F.transform(kept, header_text)), lambda h: F.size(h))
        with_h = F.zip_with(pieces, hdr, lambda p, h: F.struct(p.alias("p"), h.alias("h")))
        lab_pieces = F.zip_with(
            with_h, sups,
            lambda x, s: F.when(
                s, F.concat(F.array_repeat(F.lit(IGNORE_INDEX), x["h"]), F.slice(x["p"], x["h"] + 1, F.size(x["p"]) - x["h"]))
            ).otherwise(masked(x["p"])),
        )
    same = F.concat(F.array(F.lit(IGNORE_INDEX)), F.flatten(lab_pieces), F.array(F.lit(EOS_ID))).cast(IDS_TYPE)
    if label_alignment == "same_position":
        labels = same
    elif label_alignment == "next_token":
        labels = F.concat(F.slice(same, 2, F.greatest(F.size(same) - 1, F.lit(0))), F.array(F.lit(IGNORE_INDEX)))
    else:
        raise ValueError(f"unknown label_alignment {label_alignment!r}")
    return F.struct(ids.cast(IDS_TYPE).alias("input_ids"), labels.cast(IDS_TYPE).alias("labels"))


def supervised_count(labels: str | Column) -> Column:
    return F.size(F.filter(col_of(labels), lambda v: v != F.lit(IGNORE_INDEX)))


def tail_window(ids: Column, labels: Column, seq_len: int, min_supervised: int, n_total: Column | None = None) -> tuple[Column, Column]:
    """Use the last ``seq_len`` tokens when the head window holds fewer than
    ``min_supervised`` supervised tokens (and the dialog is longer than the window).
    ``n_total`` is the dialog's full length when ``ids`` only holds its head and tail."""
    head_sup = supervised_count(F.slice(labels, 1, seq_len))
    total = F.size(ids) if n_total is None else n_total
    use_tail = (total > F.lit(seq_len)) & (head_sup < F.lit(min_supervised))
    start = F.greatest(F.size(ids) - F.lit(seq_len) + 1, F.lit(1))
    return (
        F.when(use_tail, F.slice(ids, start, seq_len)).otherwise(ids),
        F.when(use_tail, F.slice(labels, start, seq_len)).otherwise(labels),
    )


def pad_or_truncate(values: str | Column, seq_len: int, pad: int) -> Column:
    """Cut to ``seq_len`` or pad with ``pad``."""
    return F.slice(F.concat(col_of(values), F.array_repeat(F.lit(pad), seq_len)), 1, seq_len)


def attention_mask(ids: str | Column, pad_id: int = PAD_ID) -> Column:
    return F.transform(col_of(ids), lambda i: (i != F.lit(pad_id)).cast("int"))


def build_examples(
    dialogs: DataFrame,
    seq_len: int,
    min_supervised: int = 0,
    encode_many: Callable[[Column], Column] = _byte_encode_many,
    label_alignment: str = "next_token",
    use_tail_window: bool = True,
    total_col: str | None = None,
) -> DataFrame:
    """``messages`` → ``input_ids, labels`` of length ``seq_len`` plus ``n_tokens``
    (before padding), ``supervised`` (after packing) and ``used_tail``."""
    packed = dialogs.withColumn("__p", mask_labels("messages", encode_many, label_alignment))
    ids, labels = F.col("__p.input_ids"), F.col("__p.labels")
    n_total = F.col(total_col).cast("long") if total_col else F.size(ids).cast("long")
    if use_tail_window and min_supervised > 0:
        tid, tlab = tail_window(ids, labels, seq_len, min_supervised, n_total)
        used_tail = (n_total > F.lit(seq_len)) & (supervised_count(F.slice(labels, 1, seq_len)) < F.lit(min_supervised))
    else:
        tid, tlab, used_tail = ids, labels, F.lit(False)
    out = (
        packed.withColumn("n_tokens", n_total)
        .withColumn("used_tail", used_tail)
        .withColumn("input_ids", pad_or_truncate(tid, seq_len, PAD_ID))
        .withColumn("labels", pad_or_truncate(tlab, seq_len, IGNORE_INDEX))
        .drop("__p")
    )
    return out.withColumn("supervised", supervised_count("labels"))


def min_supervised_filter(examples: DataFrame, n: int) -> DataFrame:
    return examples.where(F.col("supervised") >= F.lit(n))


# ---------------------------------------------------------------- splits, quotas, batches


def shuffle_rank(df: DataFrame, seed: int, id_col: str, keys: tuple[str, ...] = (), out: str = "shuffle_rank", digits: int = 3) -> DataFrame:
    """1-based rank in a seeded hash order (global, or per ``keys``), bucket-wise."""
    keyed = df.withColumn("__k", order_key(seed, *keys, id_col)).withColumn("__b", hex_bucket(F.col("__k"), digits))
    return bucketed_rank(keyed, list(keys), "__b", ["__k", id_col], out).drop("__k", "__b")


def val_first_n(ranked: DataFrame, val_examples: int, max_train_examples: int | None = None, rank: str = "shuffle_rank") -> DataFrame:
    """First ``val_examples`` rows (in shuffle order) → val, the rest → train, train
    stopping after ``max_train_examples``."""
    split = F.when(F.col(rank) <= F.lit(val_examples), F.lit("val")).otherwise(F.lit("train"))
    out = ranked.withColumn("split", split)
    if max_train_examples is not None:
        out = out.where((F.col("split") == "val") | (F.col(rank) <= F.lit(val_examples + max_train_examples)))
    return out


def quota_examples(df: DataFrame, spark: SparkSession, weights: dict[str, float], total: int, seed: int, id_col: str) -> DataFrame:
    """Weighted example counts per chat source: ``allocate_targets`` on counts, then
    the first ``quota`` rows of each source in seeded order."""
    from quire.operators.mixture import allocate_targets

    tot_w = 0.0
    for w in weights.values():
        tot_w += w
    src = spark.createDataFrame([(k, v / tot_w) for k, v in weights.items()], "source string, share double")
    quotas = allocate_targets(src, total, "quota")
    ranked = shuffle_rank(df, seed, id_col, keys=("source",), out="source_rank")
    return ranked.join(F.broadcast(quotas.select("source", "quota")), "source").where(F.col("source_rank") <= F.col("quota"))


def epoch_batches(df: DataFrame, seed: int, epoch: int, batch_size: int, id_col: str) -> DataFrame:
    """Reshuffle for ``epoch`` and cut into batches: ``epoch_rank``, ``batch``."""
    keyed = df.withColumn("__e", F.lit(epoch))
    ranked = shuffle_rank(keyed, seed, id_col, keys=("__e",), out="epoch_rank").drop("__e")
    return ranked.withColumn("batch", F.floor((F.col("epoch_rank") - 1) / F.lit(batch_size)).cast("long"))


def step_batches(df: DataFrame, micro_batch: int, accum: int, rank: str = "epoch_rank") -> DataFrame:
    """Optimizer step (0-based) and micro-step each row feeds."""
    per_step = micro_batch * accum
    return df.withColumn("step", F.floor((F.col(rank) - 1) / F.lit(per_step)).cast("long")).withColumn(
        "micro_step", F.floor(((F.col(rank) - 1) % F.lit(per_step)) / F.lit(micro_batch)).cast("long")
    )


def sft_report(examples: DataFrame, seq_len: int) -> DataFrame:
    return examples.groupBy("split", "source").agg(
        F.count(F.lit(1)).alias("num_examples"),
        F.sum("supervised").alias("supervised_tokens"),
        F.lit(seq_len).alias("seq_len"),
    )


def supervision_stats(examples: DataFrame) -> DataFrame:
    """Per source: examples, supervised tokens, non-pad tokens, mean ratio."""
    nonpad = F.size(F.filter("input_ids", lambda i: i != F.lit(PAD_ID)))
    return examples.groupBy("source").agg(
        F.count(F.lit(1)).alias("examples"),
        F.sum("supervised").alias("supervised_tokens"),
        F.sum(nonpad).alias("tokens"),
        F.min("supervised").alias("min_supervised"),
        F.max("supervised").alias("max_supervised"),
    )


def window_turns(turns: DataFrame, seq_len: int, count_tokens: Callable[[Column], Column] | None = None,
                 conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 turns_per_bucket: int = 1024) -> DataFrame:
    """Row-per-turn chat → one row per dialog holding only the messages that overlap
    its first or last ``seq_len`` tokens, plus ``n_total`` (the full example length).

    Message pieces are tokenized one by one, so their token counts add up; a bucketed
    prefix sum over turns gives every message's position, and only messages that reach
    into the head window or the tail window are collected. ``build_examples(...,
    total_col="n_total")`` then produces exactly the examples of the full dialog while
    no group holds more than about two windows of messages, however long the dialog."""
    from quire.plans.prefix import exclusive_prefix_sums

    if count_tokens is None:
        def count_tokens(piece: Column) -> Column:
            return F.octet_length(piece).cast("long")

    msg = F.struct(F.col(role).alias("role"), F.col(text).alias("content"))
    kept = turns.where(F.col(role).isNotNull() & F.col(text).isNotNull() & has_content(F.col(text)))
    kept = kept.withColumn("__n", count_tokens(render_message(msg)))
    kept = kept.withColumn("__b", F.floor(F.col(turn) / F.lit(turns_per_bucket)).cast("long"))
    pos = exclusive_prefix_sums(kept, [conv], "__b", [turn], {"__cum": "__n"})
    totals = kept.groupBy(conv).agg((F.sum("__n") + F.lit(2)).alias("n_total"))  # + bos, eos
    pos = pos.join(totals, conv)
    start = F.col("__cum") + F.lit(1)  # position of the piece's first token (after bos)
    head = start <= F.lit(seq_len)  # position seq_len is the last next-token label of the head
    tail = start + F.col("__n") > F.col("n_total") - F.lit(seq_len)
    sel = pos.where(head | tail)
    packed = sel.groupBy(conv, "n_total").agg(F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), msg.alias("m")))).alias("__m"))
    return packed.select(conv, "n_total", F.transform("__m", lambda x: x["m"]).cast(MESSAGE_TYPE).alias("messages"))
