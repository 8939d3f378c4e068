"""Golden cases for the column functions (text, dates, classification)."""

import datetime as dt
import os
import urllib.parse

import pytest
from pyspark.sql import functions as F

from rosterkit.functions import classify as K
from rosterkit.functions import dates as D
from rosterkit.functions import text as T


def col1(spark, values, expr_fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


def test_trim_matches_python_strip(spark):
    vals = ["  a ", "\u00a0b\u2003", "\x1cc\x1f", "\td\n", "e", "", "\u3000 f \u205f"]
    assert col1(spark, vals, T.trim_u) == [v.strip() for v in vals]


def test_email_key_and_alnum(spark):
    assert col1(spark, ["  A@B.com ", "   ", None, "x@y"], T.email_key) == ["a@b.com", None, None, "x@y"]
    assert col1(spark, [" Student Email ", "e-mail!", None], T.alnum_key) == ["studentemail", "email", None]


def test_normalize_name_unicode_ws(spark):
    assert col1(spark, ["  Mary\u00a0 Ann ", None, "BOB\t\tLee"], T.normalize_name) == \
        ["mary ann", "", "bob lee"]


def test_status_rules(spark):
    vals = ["current", " Current ", "No  Mentor", "current - no mentor", "CURRENT-NO MENTOR",
            "Graduated ", "", None]
    assert col1(spark, vals, T.normalize_status) == \
        ["Current", "Current", "No Mentor", "No Mentor", "No Mentor", "Graduated", "", None]


def test_vertical_precedence_and_misfires(spark):
    vals = ["System-on-Chip (SoC)", "csme (graduate students only)", "Radiation Hardening (RH)",
            "Associate program", "Overhead", "Trusted AI lab", "hi/ap", "Other ", "", None]
    # D11: 'soc' inside 'associate' and 'rh' inside 'overhead' are kept on purpose.
    assert col1(spark, vals, T.translate_vertical) == \
        ["SoC", "SoC", "RH", "SoC", "RH", "TAI", "HI/AP", "Other", "", None]


def test_gender_and_yes_no(spark):
    assert col1(spark, ["Man", " WOMAN ", "female", "Non-binary", None], T.translate_gender) == \
        ["Male", "Female", "Female", "Non-binary", None]
    # Not stripped, so ' yes ' is not a yes.
    assert col1(spark, ["Yes", "n", "1", "TRUE", " yes ", "1.0", None], T.yes_no_flag) == \
        [1, 0, 1, 1, None, None, None]


def test_safe_filename_and_resume_name(spark):
    assert col1(spark, ['A/B: "C"?', "  Acme  Corp.. ", "", None, "...", ": ."], T.safe_filename) == \
        ["A_B_ _C__", "Acme Corp", "Unknown_Employer", "Unknown_Employer", "Unknown_Employer", "_ "]
    df = spark.createDataFrame([("Ann ", " Lee", ".PDF"), (None, None, None), ("_x_", "", ".docx")],
                               "f string, l string, e string")
    got = [r[0] for r in df.select(T.resume_filename("f", "l", "e")).collect()]
    assert got == ["Ann_Lee_Resume.pdf", "Unknown_Student_Resume.pdf", "x_Resume.docx"]


def test_url_quote_matches_urllib(spark):
    names = ["Ann Lee_Resume.pdf", "José~Ñ (1).pdf", "a+b&c=d#e.pdf", "x_y-z.doc"]
    assert col1(spark, names, T.url_quote) == [urllib.parse.quote(n) for n in names]


def test_resume_url_branches_and_hyperlink(spark):
    df = spark.createDataFrame([("A B.pdf",)], "n string")
    r = df.select(
        T.resume_url("n", file_base_url="https://h/r/").alias("a"),
        T.resume_url("n", folder_base_url="https://h/:f:/s/x").alias("b"),
        T.resume_url("n", folder_base_url="https://h/r").alias("c"),
        T.resume_url("n", local_dir="C:\\out").alias("d"),
        T.hyperlink_formula(F.lit('u"q')).alias("e"), T.hyperlink_formula(F.lit("")).alias("f"),
    ).first()
    assert r.a == "https://h/r/A%20B.pdf?web=1"
    assert r.b == "https://h/:f:/s/x#file=A%20B.pdf"
    assert r.c == "https://h/r/A%20B.pdf"
    assert r.d == "file:///C:/out/A B.pdf"
    assert r.e == '=HYPERLINK("u""q","View Resume")' and r.f == ""


def test_extract_employer(spark):
    vals = ["x application to  Acme  through y", "application to A through b application to B through c",
            "application to \nX through", "application to  through", "nothing", None]
    assert col1(spark, vals, T.extract_employer) == \
        ["Acme", "A", "Unknown_Employer", "Unknown_Employer", "Unknown_Employer", "Unknown_Employer"]


def test_person_key(spark):
    df = spark.createDataFrame([("A", "B", " X@Y "), (" Ann", "Lee ", ""), (None, None, None)],
                               "f string, l string, e string")
    assert [r[0] for r in df.select(T.person_key("f", "l", "e")).collect()] == \
        ["email:x@y", "name:ann lee", None]


@pytest.mark.parametrize("name", ["a.b.PDF", ".bashrc", "file.", "noext", "dir.x/file", "..pdf", "a/b.c.d"])
def test_extension_matches_splitext(spark, name):
    assert col1(spark, [name], T.file_extension) == [os.path.splitext(name)[1].lower()]


def test_truncate_counts_characters(spark):
    s = "é" * 600
    assert col1(spark, ["  " + s], lambda c: T.truncate_text(c, 499)) == [s[:499]]


# ------------------------------------------------------------------ dates

def d(y, m, day):
    return dt.date(y, m, day)


def test_strict_terms(spark):
    vals = ["Fall 2024", "FA 24", "24 Spring", "Spring '25", "Spring ’25", "Fall-2024", "Fall 20265",
            "Su26", "Fall 24 Spring 25", "Fall 99", "Fall 202", "junk", None]
    got = col1(spark, vals, lambda c: D.term_to_date(c, "start", "strict"))
    assert got == [d(2024, 8, 15), d(2024, 8, 15), d(2024, 1, 15), d(2025, 1, 15), d(2025, 1, 15),
                   d(2024, 8, 15), None, None, d(2024, 8, 15), d(2099, 8, 15), d(202, 8, 15), None, None]
    assert col1(spark, ["Su26"], lambda c: D.term_to_date(c, "end", "strict", allow_joined=True)) == \
        [d(2026, 8, 15)]


def test_loose_graduation_terms(spark):
    vals = ["Fall 20265", "12026 Fall", "Sp, 2021", "Spring '26", "2026-05-15", "sometime"]
    assert col1(spark, vals, D.graduation_date) == \
        [d(2026, 12, 15), d(2026, 12, 15), d(2021, 5, 15), d(2026, 5, 15), d(2026, 5, 15), None]


def test_date_text_closed_formats(spark):
    vals = ["2024", "2024-05", "May 2026", "15/05/2026", "5/15/26", "5/15/2026", "March 3, 2024",
            "2024-05-15 10:30:00", "Fall", "x"]
    assert col1(spark, vals, D.parse_date_text) == \
        [d(2024, 1, 1), d(2024, 5, 1), d(2026, 5, 1), d(2026, 5, 15), d(2026, 5, 15), d(2026, 5, 15),
         d(2024, 3, 3), d(2024, 5, 15), None, None]


def test_formats_and_years(spark):
    df = spark.createDataFrame([(d(2024, 8, 15), d(2026, 5, 15)), (d(202, 1, 2), None)], "a date, b date")
    r = df.select(D.format_mdy("a"), D.format_mmddyyyy("a"), D.format_month_year("a"),
                  D.years_between("a", "b")).collect()
    assert tuple(r[0]) == ("8/15/2024", "08/15/2024", "August 2024", 1.75)
    assert r[1][0] == "1/2/202" and r[1][3] is None


def test_start_from_graduation(spark):
    df = spark.createDataFrame([(d(2026, 8, 15), "Masters"), (d(2026, 12, 15), "BS"),
                                (d(2026, 3, 1), "PhD"), (None, "BS")], "g date, deg string")
    got = [r[0] for r in df.select(D.start_from_graduation("g", K.program_years_prior("deg"))).collect()]
    # Any month other than August starts on Aug 15.
    assert got == [d(2024, 5, 15), d(2022, 8, 15), d(2022, 8, 15), None]


# ------------------------------------------------------------------ classification

def test_student_flag_numeric_rules(spark):
    vals = ["20", "20.0", "20.5", "19.5", "21.5", " 20 ", "2e1", "20D", "inf", "1", "yes", "Y", "True",
            "no", None]
    assert col1(spark, vals, K.student_defense_flag) == \
        [True, True, True, True, False, True, True, False, False, False, True, True, True, False, False]


def test_work_flag(spark):
    vals = ["1", "1.4", "1.5", "0.5", "yes", "no", ".9", "+1", None]
    assert col1(spark, vals, K.work_defense_flag) == [True, True, False, False, True, False, True, True, False]


def test_degree_rules(spark):
    vals = ["MS", "M.Sc.", "Ph.D", "Doctorate", "Masters", "BS", "MBA", "MEng", "Systems BS", "", None]
    assert col1(spark, vals, K.is_graduate_degree) == \
        [True, True, True, True, True, False, False, False, False, False, False]
    # D11: 'ms' inside 'systems' makes it a master's -> PHD, 2 years.
    assert col1(spark, vals, K.degree_code) == \
        ["PHD", "PHD", "PHD", "PHD", "PHD", "BS", "BS", "BS", "PHD", "BS", "BS"]
    assert col1(spark, vals, K.program_years_prior) == [2, 2, 4, 4, 2, 4, 4, 4, 2, 4, 4]
