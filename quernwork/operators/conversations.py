"""Conversations from messages in long form, their checks, and prompts for evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def role_name(role: Column) -> Column:
    low = F.lower(F.trim(role))
    return F.when(low == "human", "user").when(low == "bot", "assistant").otherwise(low)


def conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, messages): array of (role, content) by turn; messages logged more than once count once."""
    rows = messages.select("conv_id", "turn", role_name(F.col("role")).alias("role"), "content").distinct()
    listed = F.sort_array(F.collect_list(F.struct("turn", "role", "content")))
    said = F.transform(listed, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return rows.groupBy("conv_id").agg(said.alias("messages"))


def without_system(messages: Column) -> Column:
    """The system message at the head joined to the user message after it, by an empty line."""
    head, second = F.get(messages, F.lit(0)), F.get(messages, F.lit(1))
    both = F.struct(second["role"].alias("role"), F.concat(head["content"], F.lit("\n\n"), second["content"]).alias("content"))
    rest = F.slice(messages, F.lit(3), F.greatest(F.size(messages) - 2, F.lit(0)))
    return F.when(head["role"] == "system", F.concat(F.array(both), rest)).otherwise(messages)


def _turns_alternate(messages: Column) -> Column:
    wants = lambda i: F.when(i % 2 == 0, "user").otherwise("assistant")
    return F.forall(F.transform(messages, lambda m, i: m["role"].eqNullSafe(wants(i))), lambda x: x)


def fault(messages: Column, least: int = 2) -> Column:
    """The first rule that a stored conversation breaks, or null: number of messages, turns of the roles, contents that
    are no text. Blank contents are sound."""
    return (
        F.when(F.size(messages) < least, "too_few")
        .when(~_turns_alternate(messages), "roles")
        .when(F.exists(messages, lambda m: m["content"].isNull()), "no_content")
    )


def generated_fault(messages: Column, least: int = 2) -> Column:
    """The first rule that a generated conversation breaks, or null: as ``fault``, and no content is blank. White space
    of any script is blank."""
    blank = F.exists(messages, lambda m: T.strip(m["content"]) == "")
    return F.coalesce(fault(messages, least), F.when(blank, "blank"))


def request_fault(
    messages: Column,
    temperature: Column,
    top_k: Column,
    max_tokens: Column,
    most: int = 500,
    most_chars: int = 8000,
    most_total: int = 32_000,
) -> Column:
    """The first limit that a request breaks, or null. Settings that are null are not given and are sound."""
    sizes = F.transform(messages, lambda m: F.coalesce(F.length(m["content"]), F.lit(0)))
    empty_at, long_at = F.array_position(sizes, F.lit(0)), F.array_position(F.transform(sizes, lambda s: s > most_chars), F.lit(True))
    # messages are tested one by one, so that of an empty and a long one the first counts
    first_empty = (empty_at > 0) & ((long_at == 0) | (empty_at < long_at))
    return (
        F.when(F.size(messages) == 0, "no_messages")
        .when(F.size(messages) > most, "too_many_messages")
        .when(first_empty, "empty_message")
        .when(long_at > 0, "message_too_long")
        .when(F.aggregate(sizes, F.lit(0), lambda a, s: a + s) > most_total, "conversation_too_long")
        .when(F.exists(messages, lambda m: ~F.coalesce(m["role"].isin("user", "assistant"), F.lit(False))), "bad_role")
        .when(~temperature.between(0.0, 2.0), "temperature")
        .when(~top_k.between(0, 200), "top_k")
        .when(~max_tokens.between(1, 4096), "max_tokens")
    )


def _shown(shots: Column, delimiter: str, trimmed: bool = False) -> Column:
    """Solved examples struct(before, after), each followed by an empty line."""
    before = lambda s: T.strip(s["before"]) if trimmed else s["before"]
    return F.array_join(F.transform(shots, lambda s: F.concat(before(s), F.lit(delimiter), s["after"], F.lit("\n\n"))), "")


def choice_prompts(query: Column, choices: Column, shots: Column, delimiter: str = " ") -> Column:
    """One prompt for each choice: the solved examples (query, right choice), then the query and the choice."""
    head = F.concat(_shown(shots, delimiter), query, F.lit(delimiter))
    return F.transform(choices, lambda c: F.concat(head, c))


def context_prompts(contexts: Column, continuation: Column, shots: Column, delimiter: str = " ") -> Column:
    """One prompt for each context, after the solved examples (right context, continuation), all with the same end."""
    head = _shown(shots, delimiter)
    return F.transform(contexts, lambda c: F.concat(head, c, F.lit(delimiter), continuation))


def continued_prompts(context: Column, continuation: Column, shots: Column, delimiter: str = " ") -> Column:
    """The prompt without its continuation, stripped, and with it; contexts are stripped."""
    head = F.concat(_shown(shots, delimiter, trimmed=True), T.strip(context), F.lit(delimiter))
    return F.array(T.strip(head), F.concat(head, continuation))


def mean_loss(options: DataFrame) -> DataFrame:
    """(rec_id, option, loss) of (rec_id, option, start, end, losses): the mean of the losses that predict the option's
    tokens, which stand one place before them."""
    span = F.slice("losses", F.col("start"), F.col("end") - F.col("start"))
    loss = F.aggregate(span, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(span), F.lit(0))
    return options.select("rec_id", "option", loss.alias("loss"))


def spans(kind: str, sequences: Column) -> Column:
    """array of struct(start, end) of what is scored in each of the token sequences of one item.

    ``choices`` share their head and are scored from where any two differ; ``contexts`` share their end and are scored
    in it; of ``continued`` only the second is scored, from the length of the first, which must be its head (else null).
    """
    ends = lambda s: F.size(s)
    first = F.get(sequences, F.lit(0))
    if kind == "continued":
        second = F.get(sequences, F.lit(1))
        heads = (F.slice(second, F.lit(1), F.size(first)) == first) & (F.size(first) < F.size(second))
        return F.when(heads, F.array(F.struct(F.size(first).alias("start"), F.size(second).alias("end"))))
    alike = F.array_min(F.transform(sequences, lambda s: common_length(first, s, suffix=kind == "contexts")))
    start = lambda s: ends(s) - alike if kind == "contexts" else alike
    return F.transform(sequences, lambda s: F.struct(start(s).alias("start"), ends(s).alias("end")))


def common_length(a: Column, b: Column, suffix: bool = False) -> Column:
    """How many elements two arrays have in common at their head, or at their end."""
    x, y = (F.reverse(a), F.reverse(b)) if suffix else (a, b)
    n = F.least(F.size(a), F.size(b))
    differs = F.zip_with(F.slice(x, F.lit(1), n), F.slice(y, F.lit(1), n), lambda p, q: ~p.eqNullSafe(q))
    at = F.array_position(differs, True)
    return F.when(at > 0, at - 1).otherwise(n).cast("int")
