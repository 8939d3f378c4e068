"""Column -> Column functions (all native Spark expressions)."""

from .classify import (degree_code, is_graduate_degree, is_masters_degree, program_years_prior,
                       student_defense_flag, work_defense_flag)
from .dates import (flexible_date, format_mdy, format_mmddyyyy, format_month_year, graduation_date,
                    days_before, parse_date_text, start_from_graduation, term_parts, term_to_date,
                    years_between)
from .text import (alnum_key, blank_to_null, collapse_ws, composite_key, display_name, email_key,
                   extract_employer, file_basename, file_extension, hyperlink_formula, normalize_name,
                   normalize_status, person_key, resume_filename, resume_url, safe_filename,
                   translate, translate_gender, translate_vertical, trim_u, truncate_text, upper_code,
                   url_quote, yes_no_flag)

__all__ = [n for n in dir() if not n.startswith("_")]
