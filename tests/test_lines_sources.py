import os

from traitflow.sources import ingest as IN
from traitflow.sources import lines as LN
from traitflow.sources import recipes as RC
from traitflow.sources.readers import read_raw


def _write(tmp_path, name, text):
    p = os.path.join(tmp_path, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_line_rules(spark, tmp_path):
    text = 'id,desc,val\n1,"a, b",5\n2,"ab",6\n3,x,7,8\n\n4,y,9\n'
    p = _write(str(tmp_path), "f.csv", text)
    lines = LN.read_lines(spark, p)
    kept, rejected = LN.drop_quoted_delimiter_lines(lines, ",")
    assert rejected.count() == 1 and kept.count() == 5
    prof = {r[0]: r[1] for r in LN.delimiter_count_profile(lines, ",").collect()}
    assert prof == {2: 3, 3: 2}        # raw count: the quoted comma counts too; blank line skipped
    ok, bad = LN.keep_expected_width_lines(lines, ",", 2)
    assert ok.count() == 3 and bad.count() == 2
    parsed = LN.parse_lines(ok, ",", ["id", "desc", "val"])
    assert sorted(r[1] for r in parsed.collect()) == ["ab", "y"]
    quoted = LN.parse_lines(kept, ",", ["id", "desc", "val"])
    assert sorted(r[1] for r in quoted.collect() if r[1]) == ["ab", "x", "y"]
    stripped = LN.strip_double_quotes(spark.createDataFrame([('a"b""c"""',)], "value string")).first()[0]
    assert stripped == "abc"


def test_tab_unterminated_quote(spark):
    lines = spark.createDataFrame([('1\t"open\t5',), ('1\t"closed"\t5',)], "value string")
    kept, rejected = LN.drop_unterminated_quote_lines(lines, "\t")
    assert kept.count() == 1 and rejected.count() == 1


def test_bradford_recipe_cleans_and_parses(spark, tmp_path):
    header = "PseudoNHS_2023_04_24\tlab_test_performed_date\tEVENT_DESCRIPTION\tRESULT\tRESULT_UNIT_DESC\n"
    body = ("p1\t2020-01-01\tAlb\tLess than 5\tg/L\n"
            "p1\t2020-01-01\tAlb\tless thn 5\tg/L\n"        # same reading after cleaning -> dedup
            "p1\t2020-01-02\tAlb\tNA\tg/L\n"
            "p1\t2020-01-03\tAlb\tPOSITIVE\tg/L\n"
            "p1\t2020-01-04\tAlb\t>7\tg/L\n"
            "p1\t2020-01-05\tAlb\t\tg/L\n")
    p = _write(str(tmp_path), "lab.tab", header + body)
    out = IN.ingest(spark, RC.bradford_path_2023_05(), p)
    got = sorted((str(r["test_date"]), r["result"]) for r in out.collect())
    assert got == [("2020-01-01", 5.0), ("2020-01-04", 7.0)]


def test_headerless_positional_and_exclusion(spark, tmp_path):
    d = str(tmp_path)
    _write(d, "Good_April2021.csv", "junk header\np1,x,Alb,01/02/2020,<5,g/L\np2,x,Alb,01/02/2020,NULL,g/L\n")
    _write(d, "MCH_April2021.csv", "junk header\np3,x,Alb,01/02/2020,9,g/L\n")
    df = read_raw(spark, d + "/*.csv", ",", ("NULL", ""), True, columns=RC.BARTS_2021_04_COLUMNS, file_col="file",
                  exclude_files=RC.BARTS_2021_04_PROBLEM_FILES)
    assert sorted(r["pseudo_nhs_number"] for r in df.collect()) == ["p1", "p2"]
    out = IN.ingest(spark, RC.barts_path_2021_04(), d + "/*.csv")
    assert sorted((r[0], r[3]) for r in out.collect()) == [("p1", 5.0)]
