"""Identity-number verdicts and amounts in Chinese capital numerals.

Both are SQL expressions over one text or number, so the Column helpers and the registered
SQL functions share them and stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.columns import _col

# Position weights and check characters of an 18-character identity number.
WEIGHTS = [7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2]
CHECK_CHARACTERS = "10X98765432"
ID_PATTERN = (
    r"^[1-9][0-9]{5}(18|19|20)[0-9]{2}((0[1-9])|(10|11|12))(([0-2][1-9])|10|20|30|31)[0-9]{3}[0-9Xx]$"
)
BAD_LENGTH, BAD_FORMAT, BAD_CHECK, VALID = "无效长度", "格式错误", "校验码错误", "有效身份证"

# Digits and place names, highest place first.
DIGITS = "零壹贰叁肆伍陆柒捌玖"
PLACES = ["仟", "佰", "拾", "兆", "仟", "佰", "拾", "亿", "仟", "佰", "拾", "万", "仟", "佰", "拾", "元"]
LITERAL_PLACES = ["", "拾", "佰", "仟", "万", "拾", "佰", "仟", "亿", "拾", "佰", "仟", "万", "拾", "佰", "仟"]


def check_character(text: str) -> str:
    """SQL text of the expected last character."""
    total = " + ".join(f"try_cast(substr({text}, {i}, 1) as int) * {w}" for i, w in enumerate(WEIGHTS, 1))
    return f"substr('{CHECK_CHARACTERS}', ({total}) % 11 + 1, 1)"


def id_verdict_sql(text: str) -> str:
    t = f"trim({text})"
    return (
        f"case when {text} is null then null when length({t}) <> 18 then '{BAD_LENGTH}' "
        f"when not {t} rlike '{ID_PATTERN}' then '{BAD_FORMAT}' "
        f"when {check_character(t)} <> substr({t}, 18, 1) then '{BAD_CHECK}' else '{VALID}' end"
    )


def id_verdict(name: str) -> Column:
    return F.expr(id_verdict_sql(name))


def birth_date_exists(name: str) -> Column:
    """Stricter than the verdict's pattern: the eight date characters form a real day."""
    return F.try_to_timestamp(F.substring(name, 7, 8), F.lit("yyyyMMdd")).isNotNull()


def _digit(cents: str, power: int) -> str:
    return f"substr('{DIGITS}', cast(({cents} div {10 ** power}L) % 10 as int) + 1, 1)"


def amount_text_sql(amount: str, mode: str = "correct") -> str:
    """SQL text that spells an amount below 10^16, rounded half up to cents."""
    cents = f"cast(round({amount}, 2) * 100 as bigint)"
    whole = f"({cents} div 100L)"
    jiao, fen = f"(({cents} div 10L) % 10)", f"({cents} % 10)"
    jiao_word, fen_word = _digit(cents, 1), _digit(cents, 0)
    if mode == "literal":
        # A place is written for non-zero digits only; a zero right below a written digit is read out.
        parts = []
        for i in reversed(range(len(LITERAL_PLACES))):
            zero_below = f"case when ({cents} div {10 ** (i + 1)}L) % 10 = 0 then '零' else '' end" if i else "''"
            parts.append(
                f"case when ({cents} div {10 ** (i + 2)}L) % 10 <> 0 "
                f"then concat({_digit(cents, i + 2)}, '{LITERAL_PLACES[i]}', {zero_below}) else '' end"
            )
        tail = (
            f"case when {cents} % 100 = 0 then '元整' else concat('元', "
            f"case when {jiao} <> 0 then concat({jiao_word}, '角') else '' end, "
            f"case when {fen} <> 0 then concat({fen_word}, '分') else '' end) end"
        )
        return f"concat({', '.join(parts)}, {tail})"
    spelled = ", ".join(f"{_digit(cents, 17 - i)}, '{place}'" for i, place in enumerate(PLACES))
    steps = [("零[仟佰拾]", "零"), ("零+", "零"), ("零([兆亿万元])", "$1"), ("兆[亿万]+", "兆"), ("亿万", "亿"),
             ("^[兆亿万零]+", "")]
    text = f"concat({spelled})"
    for pattern, to in steps:
        text = f"regexp_replace({text}, '{pattern}', '{to}')"
    text = f"case when {whole} = 0 then '' else {text} end"
    return (
        f"case when {amount} is null then null when {cents} = 0 then '零元整' else concat({text}, "
        f"case when {cents} % 100 = 0 then '整' else concat("
        f"case when {jiao} <> 0 then concat({jiao_word}, '角') when {whole} > 0 then '零' else '' end, "
        f"case when {fen} <> 0 then concat({fen_word}, '分') else '' end) end) end"
    )


def amount_text(name: str, mode: str = "correct") -> Column:
    return F.expr(amount_text_sql(f"cast({name} as decimal(20,4))", mode))


def register(spark: SparkSession) -> None:
    """Create the SQL functions of the batch jobs; their bodies are inlined by the optimizer."""
    bodies = {
        "validate_id_card(x string)": id_verdict_sql("x"),
        "convert_number_chinese_amount(x decimal(20,4))": amount_text_sql("x"),
    }
    for signature, body in bodies.items():
        spark.sql(f"create or replace temporary function {signature} returns string return {body}")
