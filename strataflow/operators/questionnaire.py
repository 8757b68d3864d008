"""Structure of questionnaire sheets from the order of their rows."""

from __future__ import annotations

from itertools import batched

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.sheet_cells import (
    QUESTION_TYPES,
    ROW_TYPES,
    SECTION_ROWS,
    parse_dependency,
)
from strataflow.operators.ordered import SEARCH, hot_keys, with_running

# Rows that detail a question, and the row type each of them belongs to.
OWNERS = {
    "Choice": "Question",
    "ChoiceInfo": "Choice",
    "TabularChoice": "Question",
    "TabularRow": "Question",
    "Column": "Question",
    "ColumnChoice": "Column",
}

# Levels followed in one ordered pass; deeper sheets take several.
LEVELS_PER_PASS = 16


def number_sections(sheet: DataFrame, hot: DataFrame | None | str = SEARCH) -> DataFrame:
    """Number each row's section by its place in the sheet; zero before the first."""
    starts = F.col("type").isin(*SECTION_ROWS).cast("long")
    return with_running(sheet, ["sheet_id"], "line", {"section": ("sum", starts)}, hot=hot)


def carry_owners(sheet: DataFrame, hot: DataFrame | None | str = SEARCH) -> DataFrame:
    """Line of the question, choice or column that a detail row belongs to."""
    wanted = sorted(set(OWNERS.values()))
    carried = with_running(
        sheet,
        ["sheet_id"],
        "line",
        {f"_last_{t}": ("last", F.when(F.col("type") == t, F.col("line"))) for t in wanted},
        hot=hot,
    )
    owner = F.lit(None).cast("long")
    for detail, target in OWNERS.items():
        owner = F.when(F.col("type") == detail, F.col(f"_last_{target}")).otherwise(owner)
    return carried.withColumn("owner_line", owner).drop(*[f"_last_{t}" for t in wanted])


def nest_levels(sheet: DataFrame) -> DataFrame:
    """Parent of each group and question: the nearest row above it with a lower level, of any depth.

    A row below a question needs a group without text, ``implicit_group`` marks it. The
    nearest row of each level is a running maximum, so no row looks at the rows above it.
    """
    hot = hot_keys(sheet, ["sheet_id"])
    # No section is hot where no sheet is.
    inner = SEARCH if hot is not None else None
    rows = number_sections(sheet, hot).where(F.col("type").isin("Group", "Question"))
    rows = rows.withColumn("level", F.col("level").try_cast("int"))
    # Levels don't depend on the sections.
    found = sheet.where(F.col("type").isin("Group", "Question")).select(F.col("level").try_cast("int").alias("level"))
    levels = [r["level"] for r in found.where(F.col("level").isNotNull()).distinct().toLocalIterator()]
    nothing = F.lit(None).cast("struct<line:long,type:string>")
    here = F.struct(F.col("line").cast("long").alias("line"), F.col("type"))
    rows = rows.withColumn("_parent", nothing)
    for some in batched(sorted(levels)[:-1], LEVELS_PER_PASS):
        nearest = {f"_nearest_{i}": ("max", F.when(F.col("level") == n, here)) for i, n in enumerate(some)}
        above = [F.when(F.col("level") > n, F.col(f"_nearest_{i}")) for i, n in enumerate(some)]
        rows = with_running(rows, ["sheet_id", "section"], "line", nearest, hot=inner)
        rows = rows.withColumn("_parent", F.greatest("_parent", *above, nothing)).drop(*nearest)
    return rows.withColumns(
        {
            "parent_line": F.col("_parent.line"),
            "implicit_group": F.coalesce(F.col("_parent.type") == "Question", F.lit(False)),
        }
    ).drop("_parent")


def check_sheet(sheet: DataFrame) -> DataFrame:
    """Errors and warnings of each line that has some, as arrays in a fixed order."""
    hot = hot_keys(sheet, ["sheet_id"])
    rows = carry_owners(number_sections(sheet, hot), hot)
    slugs = sheet.where(F.col("slug").isNotNull()).groupBy("sheet_id", "slug").agg(
        F.count(F.lit(1)).alias("_slug_uses")
    )
    rows = rows.join(slugs, ["sheet_id", "slug"], "left")
    rows = rows.withColumn("_needs", parse_dependency("dependencies")["slug"])
    known = slugs.select("sheet_id", F.col("slug").alias("_needs"), F.lit(True).alias("_known"))
    rows = rows.join(known, ["sheet_id", "_needs"], "left")

    kind, level = F.col("type"), F.col("level").try_cast("int")

    def message(text: str, condition: Column) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), F.lit(text))

    errors = F.array_compact(
        F.array(
            message("unknown row type", ~kind.isin(*ROW_TYPES)),
            message("row before the first section", F.col("section") == 0),
            message("detail row without owner", kind.isin(*OWNERS) & F.col("owner_line").isNull()),
            message("unknown data type", (kind == "Question") & ~F.col("data_type").isin(*QUESTION_TYPES)),
            message("level is not a positive number", kind.isin("Group", "Question") & (F.coalesce(level, F.lit(0)) < 1)),
            message("depends on an unknown question", F.col("_needs").isNotNull() & F.col("_known").isNull()),
        )
    )
    warnings = F.array_compact(
        F.array(
            message("slug is used more than once", F.col("_slug_uses") > 1),
            message("question without help text", (kind == "Question") & (F.coalesce(F.col("description"), F.lit("")) == "")),
        )
    )
    report = rows.select("sheet_id", "line", errors.alias("errors"), warnings.alias("warnings"))
    return report.where((F.size("errors") > 0) | (F.size("warnings") > 0))


def report_as_json(report: DataFrame) -> DataFrame:
    """Each reported line as the JSON object ``{line: [messages]}`` of errors and of warnings."""

    def entry(column: str):
        keyed = F.create_map(F.col("line").cast("string"), F.col(column))
        return F.when(F.size(column) > 0, F.to_json(keyed)).alias(column)

    return report.select("sheet_id", "line", entry("errors"), entry("warnings"))
