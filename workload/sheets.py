"""Questionnaire sheet queries: a sheet per brand, its lines from the part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.functions import sheet_cells
from strataflow.operators import questionnaire
from workload.base import VIEWS, query, with_views

OLD_TYPES = [*sheet_cells.TYPE_MIGRATION, *sheet_cells.REMOVED_TYPES, sheet_cells.GROUP_TYPE]
NEW_TYPES = [*sheet_cells.QUESTION_TYPES, "free text"]


def _listed(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


VIEWS["sheet"] = f"""
SELECT p_brand AS sheet_id, p_partkey AS line,
       CASE WHEN p_size <= 3 THEN 'Section' WHEN p_size <= 10 THEN 'Group' WHEN p_size <= 25 THEN 'Question'
            WHEN p_size <= 40 THEN 'Choice' WHEN p_size <= 48 THEN 'ChoiceInfo' ELSE 'Remark' END AS type,
       p_name AS text,
       CASE WHEN p_size = 7 THEN 'x' ELSE CAST(p_partkey % 14 + 1 AS VARCHAR) END AS level,
       ({_listed(NEW_TYPES)})[p_partkey % {len(NEW_TYPES)} + 1] AS data_type,
       CASE WHEN p_type = 'PROMO' THEN '' ELSE p_type END AS description,
       replace(p_name, ' ', '_') AS slug,
       CASE WHEN p_size > 20 THEN replace(p_name, 'hot ', 'cold_') || '|' || (p_size % 3 + 1) END AS dependencies,
       'required: ' || CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END || '  max_length:' || p_size ||
       ' regex :"^' || p_name || '\\"$" min_value: ' || p_retailprice || ' note: ' || p_type AS constraints,
       replace(p_name, ' ', '{{...}}|') || '| ' || p_type AS choice_list,
       replace(p_name, ' ', '|') || '\\\\' || p_type || '|' || p_brand || '\\\\choice' AS table_spec,
       ({_listed(OLD_TYPES)})[p_partkey % {len(OLD_TYPES)} + 1] AS old_type
FROM part"""


def sheet(t):
    size, key, name, kind = F.col("p_size"), F.col("p_partkey"), F.col("p_name"), F.col("p_type")

    def pick(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))

    return t.read("part").select(
        F.col("p_brand").alias("sheet_id"),
        key.alias("line"),
        F.when(size <= 3, "Section")
        .when(size <= 10, "Group")
        .when(size <= 25, "Question")
        .when(size <= 40, "Choice")
        .when(size <= 48, "ChoiceInfo")
        .otherwise("Remark")
        .alias("type"),
        name.alias("text"),
        F.when(size == 7, "x").otherwise((key % 14 + 1).cast("string")).alias("level"),
        pick(NEW_TYPES).alias("data_type"),
        F.when(kind == "PROMO", "").otherwise(kind).alias("description"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("slug"),
        F.when(
            size > 20,
            F.concat(
                F.replace(name, F.lit("hot "), F.lit("cold_")), F.lit("|"), (size % 3 + 1).cast("string")
            ),
        ).alias("dependencies"),
        F.concat(
            F.lit("required: "),
            F.when(size > 25, "true").otherwise("false"),
            F.lit("  max_length:"),
            size.cast("string"),
            F.lit(' regex :"^'),
            name,
            F.lit('\\"$" min_value: '),
            F.col("p_retailprice").cast("string"),
            F.lit(" note: "),
            kind,
        ).alias("constraints"),
        F.concat(F.replace(name, F.lit(" "), F.lit("{...}|")), F.lit("| "), kind).alias("choice_list"),
        F.concat(
            F.replace(name, F.lit(" "), F.lit("|")), F.lit("\\\\"), kind, F.lit("|"), F.col("p_brand"),
            F.lit("\\\\choice"),
        ).alias("table_spec"),
        pick(OLD_TYPES).alias("old_type"),
    )


VIEWS["sectioned"] = """
SELECT *, coalesce(sum(CASE WHEN type IN ('IntroSection', 'Section', 'CloseSection') THEN 1 ELSE 0 END)
  OVER (PARTITION BY sheet_id ORDER BY line), 0)::BIGINT AS section FROM sheet"""

VIEWS["owned"] = """
SELECT *, CASE type WHEN 'Choice' THEN last_question WHEN 'ChoiceInfo' THEN last_choice END AS owner_line
FROM (SELECT *, max(CASE WHEN type = 'Question' THEN line END) OVER w AS last_question,
             max(CASE WHEN type = 'Choice' THEN line END) OVER w AS last_choice
      FROM sectioned WINDOW w AS (PARTITION BY sheet_id ORDER BY line))"""


@query("sheet_sections", with_views("sectioned") + "SELECT sheet_id, line, type, section FROM sectioned")
def _sections(t):
    return questionnaire.number_sections(sheet(t)).select("sheet_id", "line", "type", "section")


@query(
    "sheet_owners",
    with_views("owned") + "SELECT sheet_id, line, type, owner_line FROM owned WHERE type IN ('Choice', 'ChoiceInfo')",
)
def _owners(t):
    owned = questionnaire.carry_owners(sheet(t)).select("sheet_id", "line", "type", "owner_line")
    return owned.where(F.col("type").isin("Choice", "ChoiceInfo"))


@query(
    "sheet_groups",
    with_views("sectioned")
    + """, placed AS (SELECT sheet_id, section, line, type, TRY_CAST(level AS INT) AS level FROM sectioned
   WHERE type IN ('Group', 'Question')),
parents AS (SELECT *, (SELECT max(p.line) FROM placed p WHERE p.sheet_id = c.sheet_id AND p.section = c.section
   AND p.line < c.line AND p.level < c.level) AS parent_line FROM placed c)
SELECT c.sheet_id, c.section, c.line, c.type, c.level, c.parent_line,
       coalesce(p.type = 'Question', FALSE) AS implicit_group
FROM parents c LEFT JOIN placed p ON p.sheet_id = c.sheet_id AND p.line = c.parent_line""",
)
def _groups(t):
    nested = questionnaire.nest_levels(sheet(t))
    return nested.select("sheet_id", "section", "line", "type", "level", "parent_line", "implicit_group")


@query(
    "sheet_choices",
    with_views("sheet")
    + r"""SELECT sheet_id, line, i::INT AS place, trim(regexp_replace(parts[i], '\{\.\.\.\}\s*$', '')) AS choice,
       regexp_matches(parts[i], '\{\.\.\.\}\s*$') AS has_extra
FROM (SELECT sheet_id, line, string_split(choice_list, '|') AS parts FROM sheet), unnest(range(1, len(parts) + 1)) AS u(i)""",
)
def _choices(t):
    parsed = sheet(t).select("sheet_id", "line", F.posexplode(sheet_cells.parse_choices(F.col("choice_list"))))
    return parsed.select(
        "sheet_id", "line", (F.col("pos") + 1).alias("place"), F.col("col.text").alias("choice"), "col.has_extra"
    )


@query(
    "sheet_tables",
    with_views("sheet")
    + r"""SELECT sheet_id, line, replace(split_part(table_spec, '\\', 1), '|', ',') AS choices,
       replace(split_part(table_spec, '\\', 2), '|', ',') AS table_rows, split_part(table_spec, '\\', 3) AS kind
FROM sheet""",
)
def _tables(t):
    parsed = sheet(t).select("sheet_id", "line", sheet_cells.parse_tabular(F.col("table_spec")).alias("p"))
    return parsed.select(
        "sheet_id",
        "line",
        F.array_join("p.choices", ",").alias("choices"),
        F.array_join("p.rows", ",").alias("table_rows"),
        F.col("p.kind").alias("kind"),
    )


@query(
    "sheet_dependencies",
    with_views("sheet")
    + """SELECT sheet_id, line, split_part(dependencies, '|', 1) AS needs,
       CAST(split_part(dependencies, '|', 2) AS INT) AS choice_index FROM sheet WHERE dependencies IS NOT NULL""",
)
def _dependencies(t):
    rows = sheet(t).where(F.col("dependencies").isNotNull())
    parsed = rows.select("sheet_id", "line", sheet_cells.parse_dependency(F.col("dependencies")).alias("p"))
    return parsed.select("sheet_id", "line", F.col("p.slug").alias("needs"), "p.choice_index")


@query(
    "sheet_constraints",
    with_views("sheet")
    + r""", found AS (SELECT sheet_id, line,
    regexp_extract_all(constraints, '(\w+)\s*:\s*("(?:[^"\\]|\\.)*"|\S+)', 1) AS names,
    regexp_extract_all(constraints, '(\w+)\s*:\s*("(?:[^"\\]|\\.)*"|\S+)', 2) AS raws FROM sheet),
single AS (SELECT sheet_id, line, names[i] AS name, raws[i] AS raw FROM found, unnest(range(1, len(names) + 1)) AS u(i))
SELECT sheet_id, line, name,
       CASE WHEN raw IN ('true', 'false') THEN 'boolean' WHEN regexp_matches(raw, '^[+-]?\d+$') THEN 'integer'
            WHEN regexp_matches(raw, '^[+-]?\d*\.\d+$') THEN 'numeric' ELSE 'string' END AS kind,
       CASE WHEN raw[1] = '"' THEN replace(raw[2:length(raw) - 1], '\"', '"') ELSE raw END AS value
FROM single""",
)
def _constraints(t):
    parsed = F.inline(sheet_cells.parse_constraints(F.col("constraints")))
    return sheet(t).select("sheet_id", "line", parsed)


_MIGRATION = ", ".join(f"('{old}', '{new}')" for old, new in sheet_cells.TYPE_MIGRATION.items())


@query(
    "sheet_type_migration",
    with_views("sheet")
    + f""", migration(old, new) AS (VALUES {_MIGRATION})
SELECT sheet_id, line, old_type, m.new AS new_type,
       CASE old_type WHEN 'choice-yesno' THEN 'Yes|No' WHEN 'choice-yesnodontknow' THEN 'Yes|No|Do not Know'
            ELSE '' END AS implied
FROM sheet LEFT JOIN migration m ON old_type = m.old""",
)
def _type_migration(t):
    old = F.col("old_type")
    return sheet(t).select(
        "sheet_id",
        "line",
        "old_type",
        sheet_cells.new_type(old).alias("new_type"),
        F.array_join(sheet_cells.implied_choices(old), "|").alias("implied"),
    )


@query(
    "sheet_report",
    with_views("owned")
    + f""", uses AS (SELECT sheet_id, slug, count(*) AS n FROM sheet GROUP BY sheet_id, slug),
judged AS (SELECT o.sheet_id, o.line, list_filter([
   CASE WHEN type = 'Remark' THEN 'unknown row type' END,
   CASE WHEN section = 0 THEN 'row before the first section' END,
   CASE WHEN type IN ('Choice', 'ChoiceInfo') AND owner_line IS NULL THEN 'detail row without owner' END,
   CASE WHEN type = 'Question' AND data_type = 'free text' THEN 'unknown data type' END,
   CASE WHEN type IN ('Group', 'Question') AND TRY_CAST(level AS INT) IS NULL
        THEN 'level is not a positive number' END,
   CASE WHEN dependencies IS NOT NULL AND NOT EXISTS (SELECT 1 FROM uses d WHERE d.sheet_id = o.sheet_id
        AND d.slug = split_part(o.dependencies, '|', 1)) THEN 'depends on an unknown question' END
   ], lambda m: m IS NOT NULL) AS errors, list_filter([
   CASE WHEN u.n > 1 THEN 'slug is used more than once' END,
   CASE WHEN type = 'Question' AND description = '' THEN 'question without help text' END
   ], lambda m: m IS NOT NULL) AS warnings
 FROM owned o JOIN uses u ON o.sheet_id = u.sheet_id AND o.slug = u.slug)
SELECT sheet_id, line,
  CASE WHEN len(errors) > 0 THEN '{{"' || line || '":["' || array_to_string(errors, '","') || '"]}}' END AS errors,
  CASE WHEN len(warnings) > 0 THEN '{{"' || line || '":["' || array_to_string(warnings, '","') || '"]}}' END AS warnings
FROM judged WHERE len(errors) + len(warnings) > 0""",
)
def _report(t):
    return questionnaire.report_as_json(questionnaire.check_sheet(sheet(t)))
