"""Codes, labels, limits and layouts the results depend on.

Everything here is data.  Lists and tables are in natural order.
"""

# ---- Fixed values: ethnicity summary codes, other codes mean the default.
ETHNICITY = {
    "1": "International",
    "2": "Unknown",
    "3": "Hispanic",
    "4": "Native American",
    "5": "Asian",
    "6": "African American",
    "7": "Pacific Islander",
    "8": "White",
}
ETHNICITY_DEFAULT = "Two or More"

# ---- Fixed values: reasons for rejecting a transfer course, no default.
REJECT_REASON = {
    "05": "Grade Points out of range",
    "06": "Units out of range",
    "07": "Date taken out of range",
    "08": "Multi course req not met",
    "11": "Invalid Institution",
    "13": "No equivalency",
    "15": "Transfer Rule not found",
    "16": "Blank Grade",
    "17": "Technical or Remedial",
    "18": "Student Agreement found",
    "20": "No rules for course",
    "22": "No rules found in table",
    "24": "Course too old",
    "25": "Grade Points out of range",
    "26": "Units out of range",
    "27": "Date taken out of range",
    "30": "No rules found in table",
    "31": "Blank Start Date",
    "33": "Class table record not found",
    "34": "Equiv course of WC rule not found",
    "35": "No crs_nbr match for WC rule",
    "61": "Zero score and percent",
    "62": "Test date blank",
    "63": "Negative test age",
    "64": "Test too old",
    "65": "Test date out of range",
    "66": "Score out of range",
    "67": "Percentile too low",
    "68": "Score/Percen out of range",
}

# ---- Fixed values: degree letter to credential level.
CREDENTIAL_LEVEL = {
    "A": "02",
    "B": "03",
    "E": "06",
    "H": "06",
    "M": "05",
    "T": "04",
    "V": "07",
}
CREDENTIAL_LEVEL_DEFAULT = "99"

# ---- Fixed values: load bands as (standing, lowest hours, highest hours), closed at
# both ends; None means open.  Hours between two bands have no standing.
GRADUATE_CAREERS = ["GRAD", "VETM"]
GRADUATE_BANDS = [("F", 9.0, None), ("Q", 7.0, 8.5), ("H", 4.5, 6.5), ("L", 1.0, 4.0)]
UNDERGRADUATE_CAREERS = ["UGRD", "AGI", "NDS"]
UNDERGRADUATE_BANDS = [("F", 12.0, None), ("Q", 9.0, 11.0), ("H", 6.0, 8.0), ("L", 1.0, 5.0)]

# ---- Fixed values: status letters.
WITHDRAWN = "W"
GRADUATED = "G"
LESS_THAN_HALF = "L"
CHECKOUT_APPROVED = "AP"
PROGRAM_COMPLETED = "CM"
PROGRAM_ACTIVE = "AC"
PROGRAM_STOPPED = ["DC", "CN", "LA", "DM"]
SESSION_PLAN_TYPE = "MAJ"

# ---- Fixed values: status totals in trailer order; zeros fill the position after leave.
STATUS_TOTALS = [
    ("F", "total_full"),
    ("Q", "total_three_quarter"),
    ("H", "total_half"),
    ("L", "total_less"),
    ("W", "total_withdrawn"),
    ("G", "total_graduated"),
    ("A", "total_leave"),
    ("D", "total_deceased"),
]

# ---- Fixed values: report columns, filters and labels of the admission report.
ADMISSION_MEASURES = ["apply", "admit", "will_enter"]
ADMISSION_TYPES = ["Freshmen", "Ext_Trans"]
ADMISSION_CLASSES = ["gender", "race", "res_st", "tier_designation", "college"]
UNIT_CLASSES = ["gender", "race", "res_st", "tier_designation", "acad_plan"]
UNIT_COLLEGE = "CNR"
UNIT_PLANS = ["11ENVSCBS", "15ENVSCBS", "24ENVSCBS", "31ENVSCBS"]
UNIT_SUB_PLAN = "14PSEI"
SPRING_CONNECT = "Spring Connect"

# ---- Fixed values: filters of the graduate table.
GRADUATE_TERMS = ("2111", "2187")
GRADUATE_CHECKOUTS = ["AG", "AP", "CC", "DR", "CH", "CP"]
GRADUATE_PLAN_TYPE = "MAJ"
GRADUATE_CAREER = "UGRD"
GRADUATE_EXCLUDED_PLAN = "14BMJBS"
HOME_INSTITUTION = "NCSU1"
HOME_SCHOOL_LABEL = "NCSU"
NO_SCHOOL_TYPE = "NA"
MINOR_PLAN_TYPE = "MIN"
AGREEMENT_MET = "CAAM"
REMEDIAL_LEVEL = "RM"
HISTORY_TYPE = "CEN"
FRESHMAN_ADMITS = ["FRD", "FRI"]
REQUIREMENT_SEQUENCE = 30
NO_SUB_PLAN = "NOSUBPLAN"
NOT_COUNTED_GROUP = "999999"
REQUIREMENT_SOURCE = "REQR"

# ---- Fixed values: image widths offered, the label limit and media types.
IMAGE_WIDTHS = [200, 400, 800, 1200, 1600, 2400, 3200]
MEDIA_LABEL_LIMIT = 122
MEDIA_VIDEO = "VIDEO"

# ---- Fixed values: header constants of the enrollment file.
HEADER_RECORD = "A3"
DETAIL_RECORD = "D1"
TRAILER_RECORD = "T1"
SCHOOL_CODE = "002972"
BRANCH_CODE = "00"
STANDARD_FLAG = "N"
REPORTING_LEVEL = "F"

# ---- Fixed values: header fields by first column; a field reaches to the next one.
HEADER_LAYOUT = {
    "record_type": 1,
    "school_code": 3,
    "branch_code": 9,
    "term": 11,
    "standard_flag": 26,
    "certification_date": 27,
    "reporting_level": 35,
}
HEADER_LENGTH = 35

# ---- Fixed values: detail fields by first column; a field reaches to the next one.
DETAIL_LAYOUT = {
    "record_type": 1,
    "national_id": 3,
    "first_name": 12,
    "middle_initial": 32,
    "last_name": 33,
    "name_suffix": 53,
    "academic_load_nslc": 87,
    "status_dt_nslc": 88,
    "address1": 96,
    "address2": 126,
    "city": 156,
    "state": 176,
    "zip": 178,
    "country": 187,
    "agd": 202,
    "dob": 210,
    "begin_dt": 218,
    "end_dt": 226,
    "ferpa": 235,
    "emplid": 420,
    "email_addr": 470,
    "middle_name": 599,
    "program_indicator": 674,
}
DETAIL_LENGTH = 932

# ---- Fixed values: one program slot by offset; six slots follow the detail fields.
SLOT_COUNT = 6
SLOT_FIRST_COLUMN = 675
SLOT_WIDTH = 43
SLOT_LAYOUT = {
    "cipcode": 0,
    "cip_yr": 6,
    "crd_lvl": 10,
    "prog_len": 12,
    "prglen_tp": 18,
    "prg_start": 25,
    "sp_prg_fl": 33,
    "prg_stat": 34,
    "p_stat_dt": 35,
}

# ---- Fixed values: trailer positions of the totals; the gap at 45 holds zeros.
TRAILER_COUNT_WIDTH = 6
TRAILER_ZEROS = "000000"
TRAILER_RECORDS_WIDTH = 8
