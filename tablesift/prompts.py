"""Request texts built from schema rows, and the payload around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Requests that the service knows as presets; what follows them is the system message.
PRESETS = ("<|grounding|>Read this row.", "Read this cell.")


def column_lines(columns: DataFrame) -> DataFrame:
    """(format_id, context): a line for each column in order, with its type and the forms it is printed in."""
    forms = F.when(F.size("value_examples") > 0, F.concat(F.lit("; seen as: "), F.array_join("value_examples", " | "))).otherwise("")
    about = F.when(F.coalesce("description", F.lit("")) != "", F.concat(F.lit("; "), F.col("description"))).otherwise("")
    line = F.concat(F.lit("- "), F.col("column_no").cast("string"), F.lit(": "), F.coalesce("column_name", "variable"), F.lit("; field "), F.col("variable"), F.lit("; type "), F.col("data_type"), about, forms)
    ordered = F.sort_array(F.collect_list(F.struct("column_no", line.alias("line"))))
    return columns.groupBy("format_id").agg(F.array_join(ordered["line"], "\n").alias("context"))


def payload(prompt: Column, model: str, max_tokens: int = 2048) -> Column:
    """JSON of a request: a preset is the user's text and the rest the system's; other prompts are all the user's."""
    system, user = F.lit(None).cast("string"), prompt
    for preset in PRESETS:
        hit = F.startswith(prompt, F.lit(preset))
        system = F.when(hit, F.nullif(F.trim(F.substring(prompt, len(preset) + 1, 1 << 20)), F.lit(""))).otherwise(system)
        user = F.when(hit, F.lit(preset)).otherwise(user)
    messages = F.filter(F.array(F.struct(F.lit("system").alias("role"), system.alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content"))), lambda m: m["content"].isNotNull())
    return F.to_json(F.struct(F.lit(model).alias("model"), messages.alias("messages"), F.lit(0.0).alias("temperature"), F.lit(max_tokens).alias("max_tokens")))
