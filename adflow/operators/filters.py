"""Row filters, splits and row-wise clean-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.functions.records import in_open_range

# Mail clean-up texts.
NO_SUBJECT = "No subject"
FOOTER = "\nThis mail sent via Super Awesome Free Mail"
GREETING = "Hello, %s, and welcome to the Lambda Bar And Grille!"
CLOSE_ZIPS = (19123, 19103)


def project_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)


def filter_open_range(df: DataFrame, word: str, freq: str, low: int = 3, high: int = 25) -> DataFrame:
    """Words whose frequency lies strictly between two bounds."""
    return df.where(in_open_range(F.col(freq), low, high)).select(word)


def filter_score(df: DataFrame, name: str, score: str, above: float = 5000) -> DataFrame:
    """Names with a score above the bar."""
    return df.where(F.col(score) > above).select(name)


def filter_valid_stats(stats: DataFrame, impression: str = "impression", clk: str = "clk") -> DataFrame:
    """Rows with impressions, and no more clicks than impressions."""
    return stats.where((F.col(impression) > 0) & (F.col(impression) >= F.col(clk)))


def greet_neighbours(people: DataFrame, zips: Sequence[int] = CLOSE_ZIPS) -> DataFrame:
    """A greeting for each person whose nested address has a close zip."""
    close = people.where(F.col("address.zip").isin(*zips))
    return close.withColumn("greeting", F.format_string(GREETING, F.col("name")))


def flag_split(df: DataFrame, predicate: Column, flag: str = "matched") -> DataFrame:
    """Mark rows by a predicate, NULL counting as no match; one pass serves both halves."""
    return df.withColumn(flag, F.coalesce(predicate, F.lit(False)))


def split_by_predicate(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that match and rows that do not; no row is in neither."""
    matched = F.coalesce(predicate, F.lit(False))
    return df.where(matched), df.where(~matched)


def filter_not_null(df: DataFrame, *names: str) -> DataFrame:
    """Rows where every named column is given."""
    return df.dropna(how="any", subset=list(names))


def filter_contains(lines: DataFrame, column: str, part: str) -> DataFrame:
    return lines.where(F.col(column).contains(part))


def default_subject(mail: DataFrame) -> DataFrame:
    subject = F.col("subject")
    return mail.withColumn("subject", F.when(subject == "", NO_SUBJECT).otherwise(subject))


def correct_spelling(mail: DataFrame) -> DataFrame:
    return mail.withColumn("text", F.replace("text", F.lit("your"), F.lit("you're")))


def censor(mail: DataFrame) -> DataFrame:
    return mail.withColumn("text", F.replace("text", F.lit("dynamic typing"), F.lit("**CENSORED**")))


def add_footer(mail: DataFrame) -> DataFrame:
    return mail.withColumn("text", F.concat("text", F.lit(FOOTER)))


def clean_mail(mail: DataFrame) -> DataFrame:
    """Default subject, spelling, censoring and footer, in this order."""
    return (
        mail.transform(default_subject)
        .transform(correct_spelling)
        .transform(censor)
        .transform(add_footer)
    )


def check_authorization(requests: DataFrame) -> DataFrame:
    """Set the principal where an Authorization header exists, clear it elsewhere."""
    known = F.map_contains_key("headers", "Authorization")
    return requests.withColumn("principal", F.when(known, F.lit("AUser")))


def add_fingerprint(requests: DataFrame) -> DataFrame:
    given = F.try_element_at("headers", F.lit("X-RequestFingerprint"))
    return requests.withColumn("fingerprint", F.coalesce(given, F.lit("")))
