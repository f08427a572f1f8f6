"""Brazilian public holidays as a table ``(date, name, subdivision)``; NULL subdivision = national."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ALWAYS = 0

# fixed values: (month, day, name, first year) of the national holidays with a fixed date
NATIONAL_FIXED = [
    (1, 1, "Confraternização Universal", ALWAYS),
    (4, 21, "Tiradentes", ALWAYS),
    (5, 1, "Dia do Trabalhador", ALWAYS),
    (9, 7, "Independência do Brasil", ALWAYS),
    (10, 12, "Nossa Senhora Aparecida", 1980),
    (11, 2, "Finados", ALWAYS),
    (11, 15, "Proclamação da República", ALWAYS),
    (11, 20, "Dia Nacional de Zumbi e da Consciência Negra", 2024),
    (12, 25, "Natal", ALWAYS),
]

# fixed values: (days from Easter Sunday, name) of the movable national days
NATIONAL_MOVABLE = [
    (-47, "Carnaval"),
    (-2, "Sexta-feira Santa"),
    (60, "Corpus Christi"),
]

# fixed values: (days from Easter Sunday, name, state, first year) of movable state holidays
STATE_MOVABLE = [
    (8, "Nossa Senhora da Penha", "ES", 2020),
]

# fixed values: (month, day, name, state, first year) of state holidays; those that became national end with them
STATE_FIXED = [
    (1, 23, "Dia do Evangélico", "AC", 2005),
    (3, 8, "Alusivo ao Dia Internacional da Mulher", "AC", 2002),
    (6, 15, "Aniversário do Acre", "AC", 1965),
    (9, 5, "Dia da Amazônia", "AC", 2005),
    (11, 17, "Assinatura do Tratado de Petrópolis", "AC", 1965),
    (6, 24, "São João", "AL", 1994),
    (6, 29, "São Pedro", "AL", 1994),
    (9, 16, "Emancipação política de Alagoas", "AL", ALWAYS),
    (11, 20, "Consciência Negra", "AL", 1996),
    (11, 30, "Dia do Evangélico", "AL", 2013),
    (9, 5, "Elevação do Amazonas à categoria de província", "AM", 1977),
    (11, 20, "Consciência Negra", "AM", 2010),
    (12, 8, "Nossa Senhora da Conceição", "AM", 2016),
    (3, 19, "São José", "AP", 2003),
    (7, 25, "São Tiago", "AP", 2012),
    (9, 13, "Criação do Território Federal do Amapá", "AP", ALWAYS),
    (11, 20, "Consciência Negra", "AP", 2008),
    (7, 2, "Independência da Bahia", "BA", ALWAYS),
    (3, 19, "São José", "CE", ALWAYS),
    (3, 25, "Data Magna do Ceará", "CE", 2012),
    (4, 21, "Fundação de Brasília", "DF", ALWAYS),
    (11, 30, "Dia do Evangélico", "DF", 1995),
    (10, 28, "Dia do Servidor Público", "ES", ALWAYS),
    (7, 26, "Fundação da cidade de Goiás", "GO", ALWAYS),
    (10, 24, "Pedra fundamental de Goiânia", "GO", ALWAYS),
    (7, 28, "Adesão do Maranhão à Independência", "MA", 1964),
    (12, 8, "Nossa Senhora da Conceição", "MA", 1993),
    (4, 21, "Data Magna de Minas Gerais", "MG", ALWAYS),
    (10, 11, "Criação do Estado de Mato Grosso do Sul", "MS", 1979),
    (11, 20, "Consciência Negra", "MT", 2003),
    (8, 15, "Adesão do Grão-Pará à Independência", "PA", 1996),
    (7, 26, "Memória do presidente João Pessoa", "PB", ALWAYS),
    (8, 5, "Fundação do Estado da Paraíba", "PB", 1968),
    (3, 6, "Revolução Pernambucana", "PE", 2010),
    (6, 24, "São João", "PE", ALWAYS),
    (3, 13, "Batalha do Jenipapo", "PI", ALWAYS),
    (10, 19, "Dia do Piauí", "PI", 1937),
    (12, 19, "Emancipação do Paraná", "PR", ALWAYS),
    (4, 23, "São Jorge", "RJ", 2008),
    (11, 20, "Consciência Negra", "RJ", 2002),
    (6, 29, "São Pedro", "RN", ALWAYS),
    (10, 3, "Mártires de Cunhaú e Uruaçu", "RN", 2007),
    (1, 4, "Criação do Estado de Rondônia", "RO", 1982),
    (6, 18, "Dia do Evangélico", "RO", 2002),
    (10, 5, "Criação do Estado de Roraima", "RR", 1989),
    (9, 20, "Revolução Farroupilha", "RS", 1996),
    (8, 11, "Criação da capitania de Santa Catarina", "SC", 2004),
    (11, 25, "Santa Catarina de Alexandria", "SC", 1999),
    (7, 8, "Emancipação política de Sergipe", "SE", ALWAYS),
    (7, 9, "Revolução Constitucionalista", "SP", 1997),
    (11, 20, "Consciência Negra", "SP", 2023),
    (1, 1, "Instalação do Estado do Tocantins", "TO", 1989),
    (3, 18, "Autonomia do Tocantins", "TO", 1998),
    (9, 8, "Nossa Senhora da Natividade", "TO", 1989),
    (10, 5, "Criação do Estado do Tocantins", "TO", 1989),
]

# fixed values: states of each macro-region, region ids in alphabetical order of the region names
REGION_STATES = {
    1: ["DF", "GO", "MS", "MT"],
    2: ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    3: ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    4: ["ES", "MG", "RJ", "SP"],
    5: ["PR", "RS", "SC"],
}


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by integer arithmetic on the year."""
    def div(a: Column, b: int) -> Column:
        return F.floor(a / b)

    century = div(year, 100)
    golden = year % 19
    moon = (19 * golden + century - div(century, 4) - div(8 * century + 13, 25) + 15) % 30
    epact = moon - div(moon, 28) * (1 - div(29 / (moon + 1), 1) * div(21 - golden, 11))
    weekday = (year + div(year, 4) + epact + 2 - century + div(century, 4)) % 7
    from_march_21 = epact - weekday + 7
    return F.date_add(F.make_date(year, F.lit(3), F.lit(21)), from_march_21.cast("int"))


def _rows_of_year(year: Column) -> Column:
    """The holidays of a year; those that begin later are left out."""
    def day(date: Column, name: str, state: str | None, since: int) -> Column:
        return F.struct(date.alias("date"), F.lit(name).alias("name"), F.lit(state).cast("string").alias("subdivision"),
                        F.lit(since).alias("since"))

    def fixed(month: int, number: int) -> Column:
        return F.make_date(year, F.lit(month), F.lit(number))

    def movable(days: int) -> Column:
        return F.date_add(easter_sunday(year), days)

    listed = F.array(
        *[day(fixed(m, d), n, None, y) for m, d, n, y in NATIONAL_FIXED],
        *[day(movable(k), n, None, ALWAYS) for k, n in NATIONAL_MOVABLE],
        *[day(fixed(m, d), n, s, y) for m, d, n, s, y in STATE_FIXED],
        *[day(movable(k), n, s, y) for k, n, s, y in STATE_MOVABLE],
    )
    return F.filter(listed, lambda h: h["since"] <= year)


def holiday_table(years: DataFrame, year: str = "year") -> DataFrame:
    """All holidays of the distinct years in ``years``."""
    return (
        years.select(F.col(year).cast("int").alias("year")).distinct()
        .select(F.explode(_rows_of_year(F.col("year"))).alias("h"))
        .select("h.date", "h.name", "h.subdivision")
    )


def years_covered(dates: DataFrame, column: str, extra_weeks: int = 0) -> DataFrame:
    """Every year from the first to the last date (plus ``extra_weeks``) of a date column."""
    span = dates.agg(F.min(column).alias("lo"), F.date_add(F.max(column), 7 * extra_weeks + 6).alias("hi"))
    return span.select(F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("year"))


def region_states(spark) -> DataFrame:
    """Region-to-state table ``(region_id, subdivision)`` of the 27 states."""
    rows = F.array(*[
        F.struct(F.lit(r).alias("region_id"), F.lit(s).alias("subdivision"))
        for r, states in REGION_STATES.items() for s in states
    ])
    return spark.range(1).select(F.explode(rows).alias("m")).select("m.*")
