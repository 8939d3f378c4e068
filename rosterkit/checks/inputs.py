"""Deterministic inputs derived from the driver tables.

The driver tables hold no person records, so each job is exercised on
records *derived* from them by SQL that Spark and DuckDB both run
unchanged (same functions, ``chr(39)`` for a quote, no regexes). Modulo
arithmetic on keys only chooses a *variant* of a value (case, spacing,
format, null); every row of the source tables is used.

Each entry is a SELECT over the driver tables; the Spark side runs it
with ``spark.sql`` over temp views, the oracle embeds it as a CTE.
"""

from __future__ import annotations

EMAIL_OF_CUST = "'customer#' || lpad(cast({k} AS string), 9, '0') || '@example.edu'"


def _email(k: str) -> str:
    return EMAIL_OF_CUST.format(k=k)


# Students: every customer once, plus a case/space-noisy copy of each
# (same email key, other values); for even keys the copy comes first.
STUDENTS = f"""
SELECT 2 * c_custkey + 1 AS _ordinal,
       CASE WHEN c_custkey % 17 = 0 THEN NULL
            WHEN c_custkey % 17 = 1 THEN '   '
            WHEN c_custkey % 3 = 0 THEN '  ' || upper({_email('c_custkey')})
            ELSE {_email('c_custkey')} END AS email,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'First' || cast(c_custkey AS string) END AS first_name,
       c_mktsegment AS last_name,
       CASE c_custkey % 8
            WHEN 0 THEN 'Fall ' || cast(2012 + c_nationkey % 9 AS string)
            WHEN 1 THEN 'SP ' || cast(12 + c_nationkey % 10 AS string)
            WHEN 2 THEN cast(2013 + c_custkey % 6 AS string) || ' Summer'
            WHEN 3 THEN 'Spring ' || chr(39) || cast(11 + c_nationkey % 10 AS string)
            WHEN 4 THEN 'Fall-' || cast(2014 + c_nationkey % 5 AS string)
            WHEN 5 THEN cast(2013 + c_nationkey % 6 AS string) || '-0' || cast(1 + c_custkey % 9 AS string) || '-15'
            WHEN 6 THEN 'junk ' || c_mktsegment
            ELSE NULL END AS entry_semester,
       CASE c_custkey % 7
            WHEN 0 THEN '20'
            WHEN 1 THEN '20.0'
            WHEN 2 THEN 'Yes'
            WHEN 3 THEN '1'
            WHEN 4 THEN NULL
            WHEN 5 THEN cast(c_nationkey AS string) || '.5'
            ELSE ' y ' END AS defense_experience
FROM customer
UNION ALL
SELECT CASE WHEN c_custkey % 2 = 0 THEN 2 * c_custkey ELSE 2 * c_custkey + 2 END AS _ordinal,
       ' ' || upper({_email('c_custkey')}) || ' ' AS email,
       'Copy' || cast(c_custkey AS string) AS first_name,
       'Dup' AS last_name,
       'Fall 2010' AS entry_semester,
       'no' AS defense_experience
FROM customer
"""

# Degrees: one per order, email with case noise, degree-type variants.
DEGREES = f"""
SELECT CASE WHEN o_orderkey % 5 = 0 THEN upper({_email('o_custkey')})
            WHEN o_orderkey % 23 = 0 THEN NULL
            ELSE {_email('o_custkey')} END AS student_email,
       CASE o_orderkey % 10
            WHEN 0 THEN 'MS' WHEN 1 THEN 'M.Sc.' WHEN 2 THEN 'Ph.D' WHEN 3 THEN 'Doctorate'
            WHEN 4 THEN 'Masters' WHEN 5 THEN 'BS' WHEN 6 THEN 'MBA' WHEN 7 THEN 'MEng'
            WHEN 8 THEN ' bs ' ELSE NULL END AS degree_type,
       CASE o_orderkey % 6
            WHEN 0 THEN 'Spring ' || cast(year(o_orderdate) + 16 AS string)
            WHEN 1 THEN cast(cast(o_orderdate AS date) + 7300 AS string)
            WHEN 2 THEN 'FA ' || substr(cast(year(o_orderdate) + 17 AS string), 3, 2)
            WHEN 3 THEN cast(year(o_orderdate) + 18 AS string) || ' summer'
            WHEN 4 THEN NULL
            ELSE 'unknown' END AS grad_date
FROM orders
"""

# Work experience: one per line item, flag variants driven by the line.
WORK = f"""
SELECT {_email('o_custkey')} AS student_email,
       CASE WHEN l_returnflag = 'R' THEN
                 CASE l_linenumber % 3 WHEN 0 THEN '1' WHEN 1 THEN 'yes' ELSE '1.4' END
            WHEN l_returnflag = 'A' THEN
                 CASE l_linenumber % 3 WHEN 0 THEN '0' WHEN 1 THEN '0.5' ELSE '1.5' END
            ELSE CASE l_linenumber % 2 WHEN 0 THEN NULL ELSE 'no' END END AS defense_related
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

# Header names the Spark side renames the derived columns to, so that
# header discovery (not the derivation) finds them.
STUDENT_HEADERS = {"email": "Student Email", "first_name": "First Name", "last_name": "Last Name",
                   "entry_semester": "studentScaleSemester", "defense_experience": "Defense Experience"}
DEGREE_HEADERS = {"student_email": "studentEmail", "degree_type": "Degree Type",
                  "grad_date": "Grad Date"}
WORK_HEADERS = {"student_email": "Student Email", "defense_related": "Is Defense Related"}


# Master list: every customer, names with case/space noise, DOB from the
# key (missing for some), email (missing for some), status variants, the
# application date = the customer's latest order date, and the columns
# the import template reads.
MASTER = f"""
SELECT c_custkey AS _ordinal,
       CASE WHEN c_custkey % 9 = 0 THEN '  ' || upper(c_mktsegment) || '  '
            WHEN c_custkey % 9 = 1 THEN lower(c_mktsegment)
            ELSE c_mktsegment END AS first_name,
       CASE WHEN c_custkey % 10 = 0 THEN 'Lee   ' || cast(c_nationkey AS string)
            ELSE 'Lee ' || cast(c_nationkey AS string) END AS last_name,
       CASE WHEN c_custkey % 7 = 0 THEN NULL
            WHEN c_custkey % 2 = 0 THEN cast(DATE '1990-01-01' + cast(c_custkey % 4000 AS int) AS string)
            ELSE cast(month(DATE '1990-01-01' + cast(c_custkey % 4000 AS int)) AS string) || '/'
                 || cast(day(DATE '1990-01-01' + cast(c_custkey % 4000 AS int)) AS string) || '/'
                 || cast(year(DATE '1990-01-01' + cast(c_custkey % 4000 AS int)) AS string) END AS dob,
       CASE WHEN c_custkey % 11 = 0 THEN NULL
            WHEN c_custkey % 3 = 0 THEN ' ' || upper({_email('c_custkey')})
            ELSE {_email('c_custkey')} END AS email,
       CASE c_custkey % 6 WHEN 0 THEN 'Current' WHEN 1 THEN 'current ' WHEN 2 THEN 'No Mentor'
            WHEN 3 THEN 'Current - No Mentor' WHEN 4 THEN 'Graduated' ELSE NULL END AS status,
       cast(cast(lo.last_order AS date) AS string) AS application_date,
       CASE c_custkey % 5 WHEN 0 THEN 'M' ELSE NULL END AS middle_name,
       CASE WHEN c_custkey % 4 = 0 THEN 'Dr' ELSE NULL END AS preferred_name,
       CASE c_custkey % 8
            WHEN 0 THEN 'System-on-Chip (SoC)' WHEN 1 THEN 'CSME (Graduate Students Only)'
            WHEN 2 THEN 'Radiation Hardening (RH)' WHEN 3 THEN 'Embedded Security Systems/Trusted AI (ESS/TAI)'
            WHEN 4 THEN 'Heterogeneous Integration and Advanced Packaging (HI/AP)'
            WHEN 5 THEN 'Associate track' WHEN 6 THEN 'Overhead' ELSE NULL END AS technical_area,
       'https://example.org/in/' || cast(c_custkey AS string) AS linkedin,
       CASE c_custkey % 7 WHEN 0 THEN 'Yes' WHEN 1 THEN 'n' WHEN 2 THEN '1' WHEN 3 THEN '1.0'
            WHEN 4 THEN ' yes ' WHEN 5 THEN 'FALSE' ELSE NULL END AS citizen,
       CASE c_nationkey % 5 WHEN 0 THEN 'White' WHEN 1 THEN 'Asian' ELSE NULL END AS race,
       CASE c_custkey % 6 WHEN 0 THEN 'Man' WHEN 1 THEN 'woman' WHEN 2 THEN 'Female'
            WHEN 3 THEN ' male ' WHEN 4 THEN 'Non-binary' ELSE NULL END AS gender,
       'State University ' || cast(c_nationkey AS string) AS university,
       CASE c_custkey % 6 WHEN 0 THEN 'Masters Graduate Student' WHEN 1 THEN 'PhD Graduate Student'
            WHEN 2 THEN 'First Year Undergraduate Student' WHEN 3 THEN 'Systems Engineering BS'
            WHEN 4 THEN 'Doctorate' ELSE NULL END AS educational_status,
       c_mktsegment AS major,
       CASE c_custkey % 9
            WHEN 0 THEN 'Spring ' || chr(39) || cast(20 + c_nationkey % 8 AS string)
            WHEN 1 THEN 'Fall ' || cast(2020 + c_nationkey % 8 AS string)
            WHEN 2 THEN cast(20 + c_nationkey % 8 AS string) || ' Summer'
            WHEN 3 THEN 'Fall ' || cast(2020 + c_nationkey % 8 AS string) || '5'
            WHEN 4 THEN '1' || cast(2020 + c_nationkey % 8 AS string) || ' Fall'
            WHEN 5 THEN cast(DATE '2024-05-15' + cast(c_custkey % 700 AS int) AS string)
            WHEN 6 THEN 'Sp, ' || cast(2021 + c_nationkey % 5 AS string)
            WHEN 7 THEN 'sometime'
            ELSE NULL END AS expected_graduation,
       CASE WHEN c_custkey % 2 = 0 THEN cast(DATE '2019-08-15' + cast(c_custkey % 300 AS int) AS string)
            ELSE NULL END AS program_start
FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) lo
  ON lo.o_custkey = c_custkey
"""

MASTER_HEADERS = {
    "first_name": "First Name", "last_name": "Last Name", "dob": "Date of Birth",
    "email": "Email Address", "status": "Application Status", "application_date": "Application Date",
    "middle_name": "Middle Name", "preferred_name": "Preferred Name",
    "technical_area": "NEW Technical Area", "linkedin": "LinkedIn Profile", "citizen": "US Citizen",
    "race": "Race/Ethnicity", "gender": "Gender", "university": "University",
    "educational_status": "Educational Status", "major": "Major",
    "expected_graduation": "Expected Graduation", "program_start": "Program Start Date",
}

# System export: people already in the system, one row per order of two
# kinds: urgent open orders carry the customer's name (+ a DOB that is
# off by a day for some), high-priority finished orders carry the email
# (with noise) in one of two email columns under a different name.
SYSTEM = f"""
SELECT lower(c_mktsegment) || '  ' AS first_name,
       ' lee ' || cast(c_nationkey AS string) AS last_name,
       CASE WHEN c_custkey % 7 = 0 THEN NULL
            ELSE cast(DATE '1990-01-01' + cast(c_custkey % 4000 + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS int)
                      AS string) END AS dob,
       NULL AS email,
       'mentor' || cast(o_orderkey AS string) || '@example.org' AS mentor_email
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'
UNION ALL
SELECT 'Other' AS first_name, 'Person' || cast(o_orderkey AS string) AS last_name,
       NULL AS dob,
       CASE WHEN o_orderkey % 2 = 0 THEN '  ' || upper({_email('o_custkey')}) ELSE NULL END AS email,
       CASE WHEN o_orderkey % 2 = 1 THEN {_email('o_custkey')} ELSE NULL END AS mentor_email
FROM orders
WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'
"""
SYSTEM_HEADERS = {"first_name": "firstName", "last_name": "lastName", "dob": "DOB",
                  "email": "Email", "mentor_email": "Mentor Email"}
RECONCILE_AS_OF = "2001-08-01"


# Employer-report inputs: every order is a message (received = order
# date, employer = the customer's nation named in the body), every line
# item a row of its data workbook (person from the part name). Some rows
# have no identity, some a blank email; rows with a résumé file name get
# a résumé attachment unless the line is flagged N (name case varies), and each message
# has one attachment that is not a résumé.
REPORT_BASE = """
SELECT cast(o_orderkey AS string) AS message_id, 0 AS att_pos,
       row_number() OVER (PARTITION BY l_orderkey
                          ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS _ordinal,
       o_orderdate AS received,
       CASE WHEN o_orderkey % 29 = 0 THEN 'Weekly digest'
            ELSE 'A student sent an application to ' || n_name || ' through the portal' END AS body,
       CASE WHEN p_size < 4 THEN NULL ELSE split_part(p_name, ' ', 1) END AS first_name,
       CASE WHEN p_size < 4 THEN NULL ELSE split_part(p_name, ' ', 2) END AS last_name,
       CASE WHEN p_size < 4 THEN NULL
            WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN '  '
            WHEN l_linenumber % 2 = 0 THEN upper(replace(p_name, ' ', '.')) || '@uni.edu'
            ELSE replace(p_name, ' ', '.') || '@uni.edu' END AS email,
       CASE WHEN p_size % 3 = 0 THEN replace(p_name, ' ', '_') || '.pdf' END AS resume_file_name,
       CASE WHEN l_linenumber = 1 THEN cast(cast(o_orderdate AS date) AS string) END AS uploaded,
       l_returnflag AS security_clearance, cast(l_discount AS string) AS total_percentage,
       p_type AS major, l_linenumber, l_partkey, l_orderkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey"""

REPORT_ROWS_FROM = """
SELECT message_id, att_pos, _ordinal, received, body, first_name, last_name, email, resume_file_name,
       uploaded, security_clearance, total_percentage, major
FROM {base} b"""

REPORT_ATTS_FROM = """
SELECT message_id, _ordinal + 1 AS att_pos, received,
       CASE WHEN l_partkey % 5 = 0 THEN upper(resume_file_name) ELSE resume_file_name END AS att_name
FROM {base} b WHERE resume_file_name IS NOT NULL AND security_clearance <> 'N'
UNION ALL
SELECT message_id, 100000 AS att_pos, received, 'notes_' || message_id || '.txt' AS att_name
FROM {base} b WHERE _ordinal = 0"""

REPORT_ROWS = REPORT_ROWS_FROM.format(base=f"({REPORT_BASE})")
REPORT_ATTS = REPORT_ATTS_FROM.format(base=f"({REPORT_BASE})")

REPORT_HEADERS = {"first_name": "First Name", "last_name": "Last Name", "email": "Email",
                  "resume_file_name": "Resume File Name", "uploaded": "Date Database Uploaded",
                  "security_clearance": "Security Clearance", "total_percentage": " Total  Percentage ",
                  "major": "Major"}
REPORT_TABLES = ("lineitem", "orders", "customer", "nation", "part")
REPORT_FILE_BASE = "https://files.example.org/resumes"
