"""The three jobs on small fixtures shaped like FIXTURES.md, with header
variants and the edge values listed there."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterkit.plans import reconcile as R
from rosterkit.plans import reports as P
from rosterkit.plans import scorecard as S
from rosterkit.checks.mailbox import write_xlsx


# ------------------------------------------------------------------ scorecard

@pytest.fixture(scope="module")
def score_tables(spark):
    students = spark.createDataFrame([
        (1, " Ann@X.edu ", "Ann", "Lee", "Fall 2020", "20"),
        (2, "ann@x.edu", "Dup", "Dup", "Fall 2010", "no"),          # duplicate key: first wins
        (3, "bob@x.edu", "Bob", "Ray", "SP 21", "yes"),
        (4, "   ", "Blank", "Key", "Fall 2020", "20"),              # blank key dropped
        (5, "cid@x.edu", "Cid", "Poe", "junk", "20.5"),
    ], "_ordinal long, `student email` string, `first name` string, surname string, "
       "studentScaleSemester string, `in defense` string")
    degrees = spark.createDataFrame([
        ("ann@x.edu", "BS", "Spring 2022"), ("ANN@x.edu", "M.Sc.", "Fall 2023"), ("ann@x.edu", "", None),
        ("bob@x.edu", "Ph.D", "2023-05-15"), ("nobody@x.edu", "MS", "Fall 2020"),
    ], "emailAddress string, degree string, `grad date` string")
    work = spark.createDataFrame([
        ("ann@x.edu", "1"), ("ann@x.edu", "0.5"), ("ann@x.edu", "yes"), ("bob@x.edu", "1"),
    ], "`student email` string, `defense related` string")
    return students, degrees, work


def test_scorecard_values(spark, score_tables):
    out = {r.email: r for r in S.scorecard(*score_tables).collect()}
    assert set(out) == {"Ann@X.edu", "bob@x.edu", "cid@x.edu"}
    a = out["Ann@X.edu"]
    assert (a.firstName, a.hasDefenseExperience, a.scaleStartDate, a.graduationDateUsed) == \
        ("Ann", True, "8/15/2020", "12/15/2023")
    assert a.yearsInScaleBeforeGraduation == 3.33
    assert (a.totalDegrees, a.graduateDegreeCount, a.degreeTypes) == (3, 1, "BS, M.SC.")
    assert (a.totalWorkExperiences, a.defenseWorkExperiences, a.meetsAllCriteria) == (3, 2, True)
    b = out["bob@x.edu"]
    assert (b.meetsDegreeCriteria, b.meetsStrongInternshipCriteria, b.meetsAllCriteria) == (False, False, False)
    c = out["cid@x.edu"]
    # No years -> criteria false, not NULL; 20.5 rounds half-even to 20.
    assert c.yearsInScaleBeforeGraduation is None and c.inScaleTwoPlusYears is False
    assert c.hasDefenseExperience is True and c.totalDegrees == 0 and c.degreeTypes == ""


def test_candidates_and_summary(spark, score_tables):
    p = S.ScorecardParams()
    scored = S.scorecard(*score_tables, p, keep_order=True)
    cand = S.candidates(scored, p)
    assert [r.email for r in cand.collect()] == ["Ann@X.edu"]
    assert len(cand.columns) == 12 and "meetsAllCriteria" not in cand.columns
    summ = {r.metric: r.value for r in S.score_summary(scored, p).collect()}
    assert summ == {"students_evaluated": 3.0, "students_meeting_all_criteria": 1.0,
                    "minimum_years_in_scale": 2.0, "minimum_total_work_experiences": 2.0,
                    "minimum_defense_work_experiences": 1.0}
    strict = S.ScorecardParams(min_years=4.0)
    assert S.candidates(S.scorecard(*score_tables, strict, keep_order=True), strict).count() == 0


def test_scorecard_missing_required_column(spark, score_tables):
    students, degrees, work = score_tables
    with pytest.raises(ValueError, match="no column matches"):
        S.scorecard(students.drop("student email"), degrees, work).collect()


def test_run_scorecard_picks_sheets(spark, score_tables):
    s, d, w = score_tables
    out = S.run_scorecard({"Student List": s, "Degree": d, "Work_Experience": w})
    assert set(out) == {"Candidates", "AllStudentsEvaluated", "Summary"}
    assert out["AllStudentsEvaluated"].count() == 3


# ------------------------------------------------------------------ reconcile

@pytest.fixture(scope="module")
def recon_tables(spark):
    master = spark.createDataFrame([
        (1, "Ann", "Lee", "1/2/2000", "ann@x.edu", "Current", "2024-05-20", "System-on-Chip (SoC)", "Yes",
         "Woman", "Masters Graduate Student", "Fall 2025", None),
        (2, "Bob", "Ray", "2001-03-04", "BOB@X.EDU", "current - no mentor", "2024-05-01", "RH", "n",
         "man", "PhD", "Spring '26", None),
        (3, "Cid", "Poe", None, None, "No Mentor", "2024-05-25", None, None, None, None, None, "2023-08-20"),
        (4, "Dee", "Fox", "1999-01-01", "dee@x.edu", "Graduated", "2024-05-28", None, None, None, None, None, None),
        (5, "  eve ", "KIM", None, "eve@x.edu", "Current", "2024-05-30", None, None, None, None, None, None),
        (6, "Fay", "Gu", "2002-02-02", "fay@x.edu", "Current", "2023-01-01", None, None, None, None, None, None),
    ], "_ordinal long, `First Name` string, `Last Name` string, `Date of Birth` string, `Email Address` string, "
       "`Application Status` string, `Application Date` string, `NEW Technical Area` string, `US Citizen` string, "
       "Gender string, `Educational Status` string, `Expected Graduation` string, `Program Start Date` string")
    system = spark.createDataFrame([
        ("bob", "ray", "2001-03-04", None, None),          # name+dob match
        ("X", "Y", None, None, " Ann@x.edu "),             # email match in a second email column
        ("eve", "kim", None, "other@x.edu", None),         # dob differs (None vs missing) -> no name match
        ("Fay", "Gu", "2002-02-02", "fay@x.edu", None),    # both
    ], "firstName string, lastName string, DOB string, Email string, `Mentor Email` string")
    return master, system


def test_reconcile_sets(spark, recon_tables):
    res = R.reconcile(*recon_tables, R.ReconcileParams(program_version="V2", as_of="2024-06-01"))
    fl = {r._ordinal: (r._in_name, r._in_email, r._allowed) for r in res.flagged.collect()}
    assert fl[1] == (False, True, True) and fl[2] == (True, False, True)
    assert fl[4][2] is False and fl[6] == (True, True, True)
    # eve: master DOB missing -> key 'eve|kim|None'; system DOB missing too -> they match.
    assert fl[5][0] is True
    assert sorted(r._ordinal for r in res.new_rows.collect()) == [3]
    rep = [tuple(r) for r in res.suppressed_recent.collect()]
    # The report ignores status; sorted by date desc; Fay is too old.
    assert rep == [("eve KIM", "eve@x.edu", "5/30/2024", "Name+DOB match"),
                   ("Ann Lee", "ann@x.edu", "5/20/2024", "Email match")]


def test_reconcile_properties(spark, recon_tables):
    res = R.reconcile(*recon_tables, R.ReconcileParams(program_version="V2", as_of="2024-06-01", allowed_statuses=(
        "current", "no mentor", "graduated")))
    flagged = res.flagged.collect()
    new = {r._ordinal for r in res.new_rows.collect()}
    suppressed = {r._ordinal for r in flagged if r._in_name or r._in_email}
    assert new.isdisjoint(suppressed) and new | suppressed == {r._ordinal for r in flagged}


def test_template_and_degrees(spark, recon_tables):
    master, _ = recon_tables
    p = R.ReconcileParams(program_version="V2", semester="Fall 2026")
    t = R.import_template(master, p)
    assert t.columns == list(R.TEMPLATE_COLUMNS) and len(t.columns) == 52
    a = {r.firstName: r for r in t.collect()}["Ann"]
    assert (a.vertical, a.isCitizen, a.gender, a.studentScaleSemester, a.studentCurrentStatus) == \
        ("SoC", 1, "Female", "Fall 2026", "Current")
    assert (a.agreedToDataCollection, a.holdSecurityClearance, a.scaleVersion, a.webPage) == (1, 0, "V2", None)
    assert a.scaleApplicationDate == dt.date(2024, 5, 20)
    deg = {r.studentEmail: r for r in R.degrees_tab(master, p).collect()}
    assert set(deg) == {"ann@x.edu", "BOB@X.EDU", "dee@x.edu", "eve@x.edu", "fay@x.edu"}   # P11
    assert (deg["ann@x.edu"].degreeType, deg["ann@x.edu"].graduationDate, deg["ann@x.edu"].startDate) == \
        ("PHD", dt.date(2025, 12, 15), dt.date(2023, 8, 15))
    assert (deg["BOB@X.EDU"].degreeType, deg["BOB@X.EDU"].startDate) == ("PHD", dt.date(2022, 8, 15))
    sets = R.import_set(spark, master, p)
    assert sets["WorkExperience"].count() == 0 and len(sets["WorkExperience"].columns) == 9
    assert sets["Mentoring"].columns == ["studentEmail", "mentorEmail"]


def test_reconcile_requires_names(spark, recon_tables):
    master, system = recon_tables
    with pytest.raises(ValueError):
        R.reconcile(master.drop("First Name"), system)


# ------------------------------------------------------------------ employer reports

HDR = ["First Name", "Last Name", "Email", "Resume File Name", "Date Database Uploaded", "Citizenship", "Major"]


def _messages(spark):
    wb1 = write_xlsx({"S": [HDR, ["Ann", "Lee", "ann@x.edu", "ann.pdf", None, "US", "EE"],
                            ["Bob", "Ray", "bob@x.edu", "cv.pdf", "2024-01-02", "US", "CS"],
                            [None, None, "  ", None, None, None, None],
                            ["Cid", None, None, None, None, None, "ME"]]})
    wb2 = write_xlsx({"S": [HDR + ["Extra"], ["Ann", "Lee", "ANN@x.edu", "ann.pdf", "2024-03-01", "US", "EE2", "z"]]})
    wb3 = write_xlsx({"S": [HDR, ["Dan", "Orr", "dan@x.edu", "cv.pdf", None, "US", "BIO"]]})
    t = dt.datetime
    msgs = [
        ("m1", "Archive", "a@x", t(2024, 1, 5, 9), "application to Acme / Co through", [
            ("student_data.xlsx", wb1), ("ann.pdf", b"1"), ("CV.PDF", b"2"), ("photo.png", b"3")]),
        ("m2", "Archive", "a@x", t(2024, 3, 5, 9), "application to Acme / Co through", [
            ("student_data.xlsx", wb2), ("ann.pdf", b"4")]),
        ("m3", "Archive", "a@x", t(2024, 3, 5, 9), "application to Beta through", [
            ("student_data.xlsx", wb3), ("cv.pdf", b"5")]),
        ("m4", "Archive", "a@x", t(2024, 3, 6, 9), "no employer", [("student_data.xlsx", b"broken")]),
        ("m5", "Inbox", "a@x", t(2024, 3, 6, 9), "application to Gamma through", []),
    ]
    return spark.createDataFrame(msgs, P.MESSAGE_SCHEMA)


def _cells(r):
    return {k: v for k, v in r.cells.items() if v is not None}


def test_reports_end_to_end(spark, tmp_path):
    run = P.run_reports(_messages(spark), P.ReportParams(resume_file_base_url="https://f/r"))
    rows = {(r.employer, r.cells["first name"]): r for r in run.reports.collect()}
    assert set(rows) == {("Acme / Co", "Ann"), ("Acme / Co", "Bob"), ("Acme / Co", "Cid"), ("Beta", "Dan")}
    ann = rows[("Acme / Co", "Ann")]
    assert ann["Date of Confirmed Application"] == "3/5/2024" and ann.cells["major"] == "EE2" and ann.cells["extra"] == "z"
    assert ann["Resume Link"] == '=HYPERLINK("https://f/r/Ann_Lee_Resume.pdf?web=1","View Resume")'
    assert rows[("Acme / Co", "Bob")]["Resume Link"].endswith('Bob_Ray_Resume.pdf?web=1","View Resume")')
    assert rows[("Acme / Co", "Cid")].cells["date database uploaded"] == "2024-01-02"      # F9 fill
    assert rows[("Beta", "Dan")]["Resume Link"].endswith('Dan_Orr_Resume.pdf?web=1","View Resume")')
    assert not {"citizenship", "resume file name"} & set(ann.cells)
    assert {r.report_name for r in run.reports.collect()} == {"Acme _ Co_Student_Application_Report",
                                                              "Beta_Student_Application_Report"}
    diag = {r.metric: r.value for r in run.diagnostics.collect()}
    assert diag["messages_scanned"] == 4 and diag["data_attachments_found"] == 4
    assert diag["data_attachments_processed"] == 3 and diag["attachment_read_failures"] == 1
    assert diag["employers_with_data"] == 2 and diag["unique_resumes_saved"] == 3
    assert diag["resume_mappings_updated"] == 1 and diag["resume_mappings_reused"] == 0
    assert [r.att_name for r in run.unmatched_names.collect()] == ["photo.png"]
    # One employer's report has that employer's columns only, in order of first appearance.
    beta = P.report_of(run, "Beta")
    assert beta.columns == ["Date of Confirmed Application", "First Name", "Last Name", "Email", "Date Database Uploaded", "Major", "Resume Link"]
    assert "Extra" in P.report_of(run, "Acme / Co").columns and beta.count() == 1

    from rosterkit.sources.sinks import write_reports
    out = str(tmp_path / "reports")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_reports(run.reports, out)
        assert {r.employer for r in spark.read.parquet(out).select("employer").distinct().collect()} == {"Acme / Co", "Beta"}
        write_reports(run.reports.where("employer = 'Beta'"), out)                  # B4: stale reports go
        assert {r.employer for r in spark.read.parquet(out).select("employer").distinct().collect()} == {"Beta"}
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def _mail(spark, files):
    """files: (message, received day, employer, [(name, rows or bytes)])."""
    t = lambda d: dt.datetime(2024, 1, d)
    return spark.createDataFrame([
        (m, "Archive", "s", t(d), f"application to {e} through", [(n, write_xlsx({"S": c}) if isinstance(c, list) else c) for n, c in atts])
        for m, d, e, atts in files], P.MESSAGE_SCHEMA)


def test_headers_that_drift(spark):
    D = "student_data.xlsx"
    run = P.run_reports(_mail(spark, [
        ("m1", 1, "A", [(D, [["First Name", "Email", "Employer"], ["Ann", "a@x", "own"], ["Bo", "N/A", None], ["Cy", "n/a", None]])]),
        ("m2", 2, "A", [(D, [["First Name", "EMAIL", "message_id", "Received"], ["Ann", "A@x", "id", "today"]])]),
        ("m3", 3, "B", [(D, [["First Name", "a", "a", "a.1", None], ["Di", "1", "2", "3", "4"], ["Di", "1", "2", "3", "4"]])]),
        ("m4", 3, "B", [(D, [["a", "First Name", "a", "a.1"], ["1", "Di", "2", "3"]])]),
    ]))
    got = sorted((r.employer, r["Date of Confirmed Application"], sorted(_cells(r).items())) for r in run.reports.collect())
    assert got == sorted([
        ("A", "1/2/2024", sorted({"first name": "Ann", "email": "A@x", "message_id": "id", "received": "today"}.items())),
        ("A", "1/1/2024", sorted({"first name": "Bo"}.items())), ("A", "1/1/2024", sorted({"first name": "Cy"}.items())),
        ("B", "1/3/2024", sorted({"first name": "Di", "a": "1", "a.1": "2", "a.1.1": "3", "unnamed: 4": "4"}.items())),
        ("B", "1/3/2024", sorted({"first name": "Di", "a": "1", "a.1": "2", "a.1.1": "3"}.items()))])
    names = {(r.employer, r.key): r.name for r in run.columns.collect()}
    assert names[("A", "email")] == "Email" and names[("A", "employer")] == "Employer"
    assert P.report_of(run, "A").columns[:4] == ["Date of Confirmed Application", "First Name", "Email", "Employer"]


def test_two_data_files_in_one_message(spark):
    D = "student_data.xlsx"
    head = ["First Name", "Email", "Resume File Name"]
    run = P.run_reports(_mail(spark, [
        ("m1", 1, "A", [("first.pdf", b"1"), (D, [head, ["Ann", "a@x", "second.pdf"]]), ("second.pdf", b"2"), (D, [head, ["Ann", "a@x", "first.pdf"]])]),
        ("m2", 2, "B", [("newsletter.pdf", b"3")]),
        ("m3", 3, "C", [(D, [["First Name"], ["Z"]]), ("loose.pdf", b"4")]),
    ]), P.ReportParams(resume_file_base_url="https://f/r"))
    diag = {r.metric: r.value for r in run.diagnostics.collect()}
    assert diag["unique_resumes_saved"] == 1 and diag["resume_mappings_reused"] == 1
    # Only files with a résumé column look at attachments, each at all of them.
    assert [r.att_name for r in run.unmatched_names.collect()] == ["first.pdf", "second.pdf"]
    msgs = P.scan_messages(_mail(spark, [("m1", 1, "A", [("first.pdf", b"1"), (D, [head, ["Ann", "a@x", "second.pdf"]]), ("second.pdf", b"2"), (D, [head, ["Ann", "a@x", "first.pdf"]])])]))
    events, _ = P.resume_events(P.data_rows(P.decode_data_files(P.data_files(msgs))), P.attachment_names(msgs))
    assert [(r.att_name, r.data_pos) for r in events.where("is_save").collect()] == [("second.pdf", 1)]   # the first data file's match


def test_attachment_bytes_are_pruned(spark, tmp_path):
    path = str(tmp_path / "m")
    _messages(spark).write.parquet(path)
    msgs = P.scan_messages(spark.read.parquet(path))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan(P.attachment_names(msgs)) and "content" not in plan(P.message_facts(msgs))
    assert "content" in plan(P.data_files(msgs))


def test_reports_global_name_scope(spark):
    run = P.run_reports(_messages(spark), P.ReportParams(name_scope="global"))
    rows = {(r.employer, r.cells["first name"]): r["Resume Link"] for r in run.reports.collect()}
    assert "Ann_Lee_Resume.pdf" in rows[("Acme / Co", "Ann")]


def test_streaming_store_matches_batch(spark):
    """Incremental decoding (3 micro-batches) gives the batch job's reports and counters."""
    from rosterkit.checks import q_reports as Q
    from rosterkit.session import shared_path
    from rosterkit.streaming import reports_from_store, start_decoding
    mb = Q._mailbox(spark, "/root/testdata/sf0.001")
    inbox = shared_path(spark, "inbox")
    mb.repartition(3).write.parquet(inbox)
    store = shared_path(spark, "store")
    stream = spark.readStream.schema(P.MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(inbox)
    start_decoding(stream, store, shared_path(spark, "ckpt"), Q._report_params()).awaitTermination()
    inc = reports_from_store(spark, store, Q._report_params())
    full = P.run_reports(spark.read.parquet(inbox), Q._report_params())
    assert {tuple(r) for r in inc.diagnostics.collect()} == {tuple(r) for r in full.diagnostics.collect()}
    cols = sorted(full.reports.columns)
    flat = lambda df: sorted(repr([sorted(v.items()) if isinstance(v, dict) else v for v in r]) for r in df.select(*cols).collect())
    assert flat(inc.reports) == flat(full.reports)
    # The same messages delivered again change nothing.
    mb.write.mode("append").parquet(inbox)
    start_decoding(spark.readStream.schema(P.MESSAGE_SCHEMA).parquet(inbox), store, shared_path(spark, "ckpt"), Q._report_params()).awaitTermination()
    again = reports_from_store(spark, store, Q._report_params())
    assert flat(again.reports) == flat(full.reports)


def test_import_set_guard(spark, recon_tables, tmp_path):
    master, _ = recon_tables
    base = str(tmp_path / "import")
    assert R.write_import_set(spark, master.limit(0), base, R.ReconcileParams(program_version="V2")) == []           # no new rows: nothing written
    written = R.write_import_set(spark, master, base, R.ReconcileParams(program_version="V2"))
    assert [w.rsplit("/", 1)[1] for w in written] == ["Users", "WorkExperience", "Degrees", "Mentoring"]
    assert spark.read.parquet(f"{base}/WorkExperience").count() == 0


def test_report_name_collisions(spark):
    book = write_xlsx({"S": [["First Name", "Email"], ["Ann", "a@x"]]})
    t = dt.datetime(2024, 1, 1)
    msgs = spark.createDataFrame([
        ("m1", "Archive", "s", t, "application to A/B through", [("student_data.xlsx", book)]),
        ("m2", "Archive", "s", t, "application to A:B through", [("student_data.xlsx", book)]),
    ], P.MESSAGE_SCHEMA)
    diag = {r.metric: r.value for r in P.run_reports(msgs).diagnostics.collect()}
    assert diag["employers_with_data"] == 2 and diag["reports_exported"] == 2     # D8: both map to A_B
    assert diag["report_name_collisions"] == 1


def test_resume_manifest_bytes(spark):
    """Each person's latest saved résumé, with its target name and bytes."""
    msgs = P.scan_messages(_messages(spark))
    rows = P.data_rows(P.decode_data_files(P.data_files(msgs)))
    events, _ = P.resume_events(rows, P.attachment_names(msgs), P.ReportParams(resume_file_base_url="https://f/r"))
    winners = P.resume_manifest(events)
    assert {tuple(r)[:2] for r in P.attachment_contents(msgs, winners).collect()} == {(r.message_id, r.att_pos) for r in winners.collect()}
    assert P.attachment_contents(msgs).count() > winners.count()
    got = {r.person_key: (r.target_name, bytes(r.content)) for r in P.resume_manifest(events, msgs).collect()}
    # Ann re-sent her résumé in a later message: the newer bytes win.
    assert got == {"email:ann@x.edu": ("Ann_Lee_Resume.pdf", b"4"),
                   "email:bob@x.edu": ("Bob_Ray_Resume.pdf", b"2"),
                   "email:dan@x.edu": ("Dan_Orr_Resume.pdf", b"5")}
