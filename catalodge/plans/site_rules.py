"""Rules of the known sites, as data.

FIXED VALUES: URL shapes, wordings and markers of the sites' pages. Jobs turn
these lists into small rule tables; a new site is a set of rows here or rows of a
table with the same columns, never code.
"""

from __future__ import annotations

from collections.abc import Iterator

CATALOG, DETAIL, MODULES, TERMS = "program_catalog", "program_detail", "module_catalog", "term_dates"
FACULTIES, UG, PG = "faculty_list", "ug_admissions", "pg_admissions"

# ---- discovered pages -------------------------------------------------------------------
# (school, category, page_re, page_not_re, source, scope_re, target_re, exclude_re, to_category, options)
# options: first = only the first link of each scope; clean = drop query and fix the slash;
# template = URL made from the target match; note_re = note inside the scope;
# json: items of a JSON list, value and label name their fields, target_re cuts the value.
# Further pages of a list: next (rel), numbered (pager links), full (as many target links as page_size), offset and
# indexed (JSON). scope_re: start of the opening tag of the elements looked into (NULL: the whole page);
# title ({label} is replaced), freq, method = constants of the new page; page_size = rows of a full page; unwrap = follow search redirects;
# canon = course domain whose year folder is dropped.
_UCL_ITEM = r"(?is)<div[^>]*\bresult-item\b"
_EDI_PROGRAM = r"(?i)/programmes/(?:undergraduate/(?:\d{4}/)?\d+|postgraduate-taught/\d+)-[^/?#]+/?$"
_KCL_COURSE = (
    r"/study/(?:undergraduate|postgraduate-taught)/courses/(?!course-types-and-study-options/?$)[a-z0-9-]+/?$"
)
_WARWICK_COURSE = (
    r"(?i)/study/undergraduate/courses-20\d{2}/[a-z0-9-]+/?$|"
    r"/study/postgraduate/courses(?:-20\d{2})?/(?!course-list/?$)[a-z0-9-]+/?$"
)
_BHAM_COURSE = r"(?i)/study/(?:undergraduate|postgraduate)/subjects/.+-courses/[^/?#]+/?$"
_PAGER = r"(?is)<nav[^>]*\bpagination\b"
_NEXT = r"rel\s*=\s*[\"']next[\"']"
_MAN_PORTLET = (
    "https://portal.manchester.ac.uk/uPortal/p/course-unit-info.ctf1/max/action.uP?pP_action=searchCUCatalog"
    "&career={career}&searchCriteria=subject&subjectArea={value}"
)
_LEEDS_RESULTS = "https://catalogue.leeds.ac.uk/ModuleSearch/results/{career}/202627/ALL/{raw}/False/ALL/False?keyMatch=any"
_WARWICK_LIST = "https://courses.warwick.ac.uk/modules?departments={raw}&academicYears=2025&page=0&uaDept={label}"

DISCOVERY = [
    ("ucl", CATALOG, None, None, "link", _UCL_ITEM, r"/degrees/|/taught-degrees/", None, DETAIL,
     {"first": True, "note_re": r"(?is)<span[^>]*search-results__dept[^>]*>(.*?)</span>"}),
    ("ucl", CATALOG, None, None, "next", None, _NEXT, None, CATALOG, {"title": "目录分页", "freq": "manual"}),
    ("ucl", MODULES, None, r"/module-catalogue/modules/", "link", None,
     r"/module-catalogue/modules/[a-z0-9-]+-[A-Z]{4}\d{4}/?$", None, MODULES, {}),
    ("gla", CATALOG, r"/postgraduate/", None, "link", r"(?is)<ul[^>]*\bprogramme-list\b",
     r"/postgraduate/taught/[a-z0-9-]+/?$", None, DETAIL, {}),
    ("gla", CATALOG, None, r"/postgraduate/", "link", r"(?is)<ul[^>]*\bprogramme-list\b",
     r"/undergraduate/degrees/[a-z0-9-]+/?$", None, DETAIL, {}),
    ("gla", MODULES, "browsebyschool", None, "link", None, r"/coursecatalogue/courselist/", None, MODULES, {}),
    ("gla", MODULES, None, r"browsebyschool|/courselist/", "link", None, r"/coursecatalogue/browsebyschool/?$", None,
     MODULES, {"title": "按学院浏览课程"}),
    ("gla", FACULTIES, r"/colleges/[a-z]+/?$", "/schools/", "link", None, r"/schools/[a-z]+/?$", None, FACULTIES,
     {"suffix": "postgraduate/"}),
    ("gla", FACULTIES, None, r"/schools/|/colleges/[a-z]+/?$", "link", None, r"/colleges/[a-z]+/?$", None, FACULTIES,
     {"title": "College 页"}),
    ("gla", TERMS, None, r"session\d{4}-\d{2}/?$", "link", None, r"/sessiondates/session\d{4}-\d{2}/?$", None, TERMS, {}),
    ("edi", CATALOG, None, None, "link", r"(?is)<[a-z]+[^>]*\bviews-field-title\b", _EDI_PROGRAM, None, DETAIL, {"first": True}),
    ("edi", MODULES, "cx_schindex", None, "link", None, r"/cx_s_su\d+\.htm$", None, MODULES, {}),
    ("edi", MODULES, r"/cx_s_su\d+\.htm$", None, "link", None, r"/cx_sb_\w+\.htm$", None, MODULES, {}),
    ("edi", TERMS, None, None, "link", None, r"/20\d{4}/?$", None, TERMS, {}),
    ("man", CATALOG, None, None, "link", None,
     r"(?i)/study/(?:undergraduate/courses/2026|masters/courses/list)/\d{4,6}/[^/?#]+/?$", None, DETAIL, {"clean": True}),
    ("man", MODULES, "/render\\.uP", None, "option", None, r"/CourseUnitbyCareerSubjectArea/([A-Z0-9]+)\.xml", None, MODULES,
     {"template": _MAN_PORTLET, "careers": ["UGRD", "PGDT"], "method": "portlet_post"}),
    ("bristol", CATALOG, None, None, "link", None, r"/study/postgraduate/taught/[a-z0-9-]+/?$", r"/study-online/?$", DETAIL, {}),
    ("bristol", CATALOG, None, None, "link", None, r"/study/undergraduate/20\d{2}/[^/]+/[^/]+/?$", None, DETAIL, {}),
    ("bristol", CATALOG, None, None, "link", None, r"/study/undergraduate/20\d{2}/[^/]+/?$", None, CATALOG, {}),
    ("leeds", CATALOG, None, None, "link", None, r"^https?://courses\.leeds\.ac\.uk/(?:20\d{4}/)?[a-z]\d{3,4}/[a-z0-9-]+/?$", None,
     DETAIL, {"unwrap": True, "canon": "courses.leeds.ac.uk"}),
    ("leeds", CATALOG, None, None, "link", None, r"course-search/.*(?:start_rank=|page=)", None, CATALOG,
     {"title": "Course search page"}),
    ("leeds", MODULES, None, "/ModuleSearch/results/", "option", r"(?is)<select[^>]*\bid=[\"']School[\"']",
     r"^[A-Z]{2,6}$", None, MODULES, {"template": _LEEDS_RESULTS, "careers": ["UG", "TP"]}),
    ("kcl", CATALOG, "sitemap", None, "loc", None, _KCL_COURSE, None, DETAIL, {}),
    ("kcl", CATALOG, None, "sitemap", "link", None, _KCL_COURSE, None, DETAIL, {"clean": True}),
    ("kcl", MODULES, None, "dept=", "link", None, r"/abroad/module-options/search\?dept=", None, MODULES, {}),
    ("warwick", CATALOG, None, None, "link", None, _WARWICK_COURSE, None, DETAIL, {"clean": True}),
    ("warwick", MODULES, None, "departments=", "option", r"(?is)<select[^>]*\bname=[\"']departments[\"']",
     r"\S", None, MODULES, {"template": _WARWICK_LIST, "careers": [""]}),
    ("warwick", FACULTIES, "/departments/academic", None, "link", None, r"/fac/(?:sci|arts|soc|med)/[a-z0-9]+/?$", None, FACULTIES,
     {"carry": "uaDept"}),
    ("warwick", FACULTIES, "uaDept=", None, "link", None,
     r"/fac/(?:sci|arts|soc|med)/[a-z0-9]+/(?:admissions|prospective|study|ugstudy|pgstudy)[a-z/]*$", None, FACULTIES,
     {"carry": "uaDept"}),
    ("warwick", "china_page", None, None, "link", None, "(?i)china", None, "china_page", {"clean": True}),
    ("bham", CATALOG, "sitemap", None, "loc", None, _BHAM_COURSE, "/dubai/", DETAIL, {}),
    ("bham", CATALOG, None, "sitemap", "link", None, _BHAM_COURSE, "/dubai/", DETAIL, {"clean": True}),
    ("bham", MODULES, "Action=getSchoolList", None, "link", None, "Action=getProgramList", None, MODULES, {}),
    ("bham", MODULES, "Action=getProgramList", None, "link", None, "Action=getModuleList", None, MODULES, {"carry": "uaSchool"}),
    ("shef", CATALOG, None, None, "link", None,
     r"(?i)/(?:undergraduate/courses|postgraduate/taught/courses)/20\d{2}/[^/?#]+/?$", None, DETAIL, {"clean": True}),
    ("shef", TERMS, r"/about/dates/?$", None, "link", None,
     r"(?i)/about/dates/(?:current-and-future-semester|past|non-standard-semesters)", None, TERMS, {"clean": True}),
    ("monash", CATALOG, None, None, "index", None, r"\S", None, CATALOG, {"title": "子 sitemap"}),
    ("monash", CATALOG, None, None, "loc", None, r"^https://handbook\.monash\.edu/2026/courses/[A-Za-z0-9]+$", None, DETAIL, {}),
    ("monash", CATALOG, None, None, "loc", None, r"^https://handbook\.monash\.edu/2026/units/[A-Za-z0-9]+$", None, MODULES, {}),
    ("unsw", CATALOG, None, None, "index", None, r"\S", None, CATALOG, {"title": "子 sitemap"}),
    ("unsw", CATALOG, None, None, "loc", None,
     r"^https://www\.handbook\.unsw\.edu\.au/(?:undergraduate|postgraduate)/programs/2026/[A-Za-z0-9]+/?$", None, DETAIL, {}),
    ("unsw", CATALOG, None, None, "loc", None,
     r"^https://www\.handbook\.unsw\.edu\.au/(?:undergraduate|postgraduate)/courses/2026/[A-Za-z0-9]+/?$", None, MODULES, {}),
    ("uq", CATALOG, None, None, "match", None, r"https://study\.uq\.edu\.au/study-options/programs/([a-z0-9-]+-\d{4})\b", None, DETAIL,
     {"template": "https://study.uq.edu.au/study-options/programs/{1}"}),
    ("uq", DETAIL, None, None, "self", None, r"study-options/programs/[a-z0-9-]+-(\d{4})", None, MODULES,
     {"template": "https://programs-courses.uq.edu.au/requirements/program/{1}/2026", "method": "cdp"}),
    ("uq", MODULES, "/requirements/program/", None, "match", r"(?s)\"programRequirements\".*", r"\b([A-Z]{4}\d{4})\b", None, MODULES,
     {"template": "https://programs-courses.uq.edu.au/course.html?course_code={1}", "method": "cdp"}),
    ("uwa", CATALOG, None, "/units", "link", None, r"(?:course|major)details\?code=", None, DETAIL, {}),
    ("adel", CATALOG, None, None, "loc", None, r"^https://adelaide\.edu\.au/study/courses/[a-z]{2,6}-\d{4}[a-z]*/$", None, MODULES, {}),
    ("adel", CATALOG, None, None, "loc", None, r"^https://adelaide\.edu\.au/study/degrees/[a-z0-9-]{8,}/$", None, DETAIL, {}),
    ("anu", CATALOG, "CourseSearch/GetCourses", None, "json", None, r"^\s*(.*?)\s*$", None, MODULES,
     {"template": "https://programsandcourses.anu.edu.au/2026/course/{1}", "value": "CourseCode", "label": "Name"}),
    ("anu", CATALOG, "GetProgramsUnderGraduate", None, "json", None, r"^\s*(.*?)\s*$", None, DETAIL,
     {"template": "https://programsandcourses.anu.edu.au/2026/program/{1}?uaLevel=UG", "value": "AcademicPlanCode", "label": "ProgramName"}),
    ("anu", CATALOG, "ProgramSearch/GetPrograms", "UnderGraduate", "json", None, r"^\s*(.*?)\s*$", None, DETAIL,
     {"template": "https://programsandcourses.anu.edu.au/2026/program/{1}?uaLevel=PGT", "value": "AcademicPlanCode", "label": "ProgramName"}),
    ("anu", CATALOG, "CourseSearch/GetCourses", None, "indexed", None, None, None, CATALOG, {"title": "课程 API p{label}", "page_size": 2000}),
    ("sydney", CATALOG, None, None, "offset", None, None, None, CATALOG, {"title": "Courses 枚举分页"}),
    ("sydney", MODULES, r"org\.coveo\.com", None, "offset", None, None, None, MODULES, {"title": "units 枚举分页"}),
    ("melb", CATALOG, None, "page=", "numbered", _PAGER, None, None, CATALOG, {"title": "course 目录第 {label} 页", "method": "cdp"}),
    ("melb", MODULES, None, "page=", "numbered", _PAGER, None, None, MODULES, {"title": "subject 目录第 {label} 页", "method": "cdp"}),
    ("warwick", MODULES, "departments=", None, "full", None, r"/modules/2025/([A-Z]{2,4}\d{2,4}[A-Z]?-\d+(?:\.\d+)?)/?$", None, MODULES,
     {"title": "课程名单 p{label}", "page_size": 50}),
    ("sydney", MODULES, r"org\.coveo\.com", None, "json", None, r"/units/([A-Z]{2,4}\d{4})", None, MODULES,
     {"template": "https://www.sydney.edu.au/units/{1}", "value": "clickUri", "label": "title"}),
]

# ---- detail fields ------------------------------------------------------------------------
# school -> category -> [(field, source, pattern, args)], tried in order per field.
_UCAS = ("ucas_code", "text", r"UCAS(?: course)? code\s*\n?\s*([A-Z0-9]{4,5})", None)
_UG_URL = ("level", "url_flag", r"/undergraduate/", ["UG", "PGT"])

FIELDS: dict[tuple[str, str], list[tuple]] = {
    ("ucl", DETAIL): [
        ("name_en", "h1", None, None), _UG_URL,
        ("entry_year", "text", r"UK tuition[^\n]*\((\d{4})/\d{2}\)", None), ("entry_year", "url", r"-(\d{4})/?$", None),
        ("fee_year_label", "text", r"UK tuition[^\n]*\((\d{4}/\d{2})\)", None),
        ("tuition_home", "text", r"UK tuition[^\n]*\n£\s*([\d,]+)", None),
        ("tuition_intl", "text", r"Overseas tuition[^\n]*\n£\s*([\d,]+)", None),
        ("duration", "text", r"\nDuration\n([^\n]+)", None),
        ("language_band", "text", r"English language level for this (?:course|programme) is:?\n?\s*Level (\d)", ["level-"]),
        ("entry_req_text", "text",
         r"(?:minimum of an?|Normally a minimum of an?)\s+([^.\n]*(?:class|degree|Honours)[^.\n]*)", None),
        _UCAS, ("campus", "text", r"(?:Campus|Location)\n([^\n]+)", None),
        ("app_open_date", "text", r"(?<!do not )require a visa:\s*\n?(\d{1,2} \w{3,9} \d{4})", None),
    ],
    ("gla", DETAIL): [
        ("name_en", "tail", None, None), ("level", "url_flag", r"/postgraduate/", ["PGT", "UG"]),
        ("entry_year", "text", r"Tuition fees for (\d{4})-\d{2}", None),
        ("entry_year", "text", r"Entry requirements\s*\nfor entry in (\d{4})", None),
        ("fee_year_label", "text", r"Tuition fees for (\d{4}-\d{2})", None),
        ("tuition_home", "text", r"Home & RUK\s*\n(?:Full-time fee:\s*\n)?£([\d,]+)", None),
        ("tuition_intl", "text", r"International & EU\s*\n(?:Full-time fee:\s*\n)?£([\d,]+)", None),
        ("duration", "text", r"\n(?:MSc|MRes|MEd|LLM|MBA|MLitt|MMus)[^\n]*:\s*\n(\d+ months? [a-z -]+)", None),
        ("duration", "text", r"\((\d years?)\)", None),
        ("entry_req_text", "text", r"Entry requirements\s*\n(?:for entry in \d{4}\s*\n)?([^\n]{10,300})", None),
        ("ielts_overall", "text", r"IELTS[^\n]*\n?[^\n]*?(\d\.\d|\d) (?:overall )?with no subtests?(?: less than| under) (?:\d\.\d|\d)", None),
        ("ielts_min_each", "text", r"IELTS[^\n]*\n?[^\n]*?(?:\d\.\d|\d) (?:overall )?with no subtests?(?: less than| under) (\d\.\d|\d)", None),
        ("dept", "mention", r"(?:Adam Smith Business School|School of [A-Z][A-Za-z ,&\-]{3,70})", None),
        ("ucas_code", "text", r"Apply to ([A-Z]{1,2}\d{2}[A-Z0-9]?)\b", None),
    ],
    ("edi", DETAIL): [
        ("name_en", "h1", None, None), ("level", "url_flag", r"/postgraduate-taught/", ["PGT", "UG"]),
        ("entry_year", "text", r"Year of entry:?\s*\n?\s*(\d{4})", None),
        ("ucas_code", "text", r"UCAS Code:?\s*\n\s*([^\n]+)", None), ("campus", "text", r"Study location:?\s*\n\s*([^\n]+)", None),
        ("dept", "text", r"\nSchool:?\s*\n\s*([^\n]+)", None), ("faculty", "text", r"\nCollege:?\s*\n\s*([^\n]+)", None),
        ("duration", "text", r"Duration of study:?\s*\n\s*([^\n]+)", None),
        ("duration", "text", r"\b(?:MSc|MA|LLM|MScR)\s*\|\s*([^|\n]+)\s*\|", None),
        ("entry_req_text", "section", "Qualifications",
         ["English language requirements|Fees, costs|How to apply|Programme structure", "500"]),
        ("entry_req_text", "section", "A [Ll]evels?", ["International Baccalaureate|GCSE", "300"]),
        ("ielts", "ielts", None, None),
    ],
    ("man", DETAIL): [
        ("name_en", "h1", None, None), ("level", "url_flag", r"/study/masters/", ["PGT", "UG"]),
        ("entry_year", "text", r"(?i)Year of entry:?\s*\n?\s*(\d{4})", None), ("duration", "text", r"(?i)Duration:?\s*\n?\s*([^\n]+)", None),
        ("ucas_code", "text", r"(?i)UCAS course code:?\s*\n?\s*([A-Z0-9]{4,5})", None),
        ("tuition_home", "fee", None, ["home students", "UK students"]),
        ("tuition_intl", "fee", None, ["international students", "International, including EU"]),
        ("fee_year_label", "text", r"(\d{4}/\d{2}) academic year", None), ("ielts", "ielts", None, None),
        ("entry_req_text", "section", "Academic entry qualification overview|Typical A-level offer|A-level",
         ["English language|Fees and funding|Application and selection", "500"]),
        ("dept", "pair", "department", None), ("dept", "pair", "school/faculty", None),
    ],
    ("bristol", DETAIL): [
        ("name_en", "title", r"\s*\|\s*Study at Bristol.*$", None), ("level", "url_flag", "/undergraduate/", ["UG", None]),
        ("level", "name_flag", r"\b(?:MSc|MA|LLM|MRes|MEd|PGDip|PGCert|MBA|MPH)\b", ["PGT", "PGR"]),
        ("entry_year", "url", r"/study/undergraduate/(20\d{2})/", None), ("ucas_code", "pick", None, ["ucas code", "ucas course code"]), _UCAS,
        ("duration", "pick", None, ["duration", "course duration", "study mode"]),
        ("faculty", "meta", "faculty", None), ("faculty", "name", None, None),
        ("dept", "pick", None, ["school", "department"]), ("dept", "meta", "department", None),
        ("tuition_home", "fee", None, ["Home: full-time", "Home:"]), ("tuition_intl", "fee", None, ["Overseas: full-time", "Overseas:"]),
        ("fee_year_label", "text", r"(20\d{2}/\d{2})", None),
        ("entry_req_text", "pick", None, ["entry requirements", "academic requirements"]),
        ("entry_req_text", "section", "Entry requirements?", [None, "700"]),
        ("language_band", "text", r"(?i)\bProfile\s+(?:level\s+)?([A-H])\b", ["profile-", "lower"]), ("ielts", "ielts", None, None),
    ],
    ("leeds", DETAIL): [
        ("name_en", "title", r"\s*\|\s*University of Leeds.*$", None), ("level", "url_flag", "/masters", ["PGT", None]),
        ("level", "name_flag", r"\b(?:MSc|MA|MBA|LLM|MRes|MEd|MPH|PGDip|PGCert|Masters)\b", ["PGT", "UG"]),
        ("entry_year", "url", r"/(20\d{2})\d{2}/", None), ("ucas_code", "pick", None, ["ucas code"]),
        ("duration", "pick", None, ["duration", "course duration"]), ("entry_req_text", "pick", None, ["entry requirements", "entry requirement"]),
        ("tuition_home", "fee", None, ["UK fees", "Home fees", "UK:"]), ("tuition_intl", "fee", None, ["International fees", "International:"]),
        ("faculty", "name", None, None), ("dept", "text", r"(?i)This course is taught by\s*\n([^\n]+)", None),
        ("dept", "pick", None, ["school", "department"]), ("ielts", "ielts", None, None),
    ],
    ("kcl", DETAIL): [
        ("name_en", "title", r"\s*\|\s*King's College London.*$", ["King's College London"]), _UG_URL,
        ("duration", "text", r"(?i)(?:Duration|Course length|Length)\s*\n([^\n]{2,120})", None), _UCAS,
        ("campus", "text", r"(?i)(?:Campus|Location|Teaching location)\s*\n([^\n]{2,120})", None),
        ("tuition_home", "fee", None, ["Home fee", "UK fee", "Home:"]),
        ("tuition_intl", "fee", None, ["International fee", "Overseas fee", "International:"]),
        ("entry_req_text", "section", "Entry requirements|Academic requirements",
         ["English language requirements|Fees and funding|Teaching|Apply|Careers", "500"]),
        ("faculty", "name", None, None), ("language_band", "text", r"(?i)\bBand\s+([A-E])\b", ["band-", "upper"]), ("ielts", "ielts", None, None),
    ],
    ("warwick", DETAIL): [
        ("name_en", "title", r"\s*(?:\||-)\s*(?:University of Warwick|Warwick).*$", None), _UG_URL,
        ("entry_year", "url", r"/courses-(20\d{2})/", None), _UCAS,
        ("duration", "text", r"(?i)(?:Duration|Course length|Length)\s*\n([^\n]{2,120})", None),
        ("duration", "text", r"(?i)(\d+(?:\.\d+)?\s+years?\s+(?:full|part)-time)", None),
        ("duration", "text", r"(?i)(\d+\s+months?\s+(?:full|part)-time)", None),
        ("campus", "text", r"(?i)(?:Location|Campus)\s*\n([^\n]{2,120})", None), ("dept", "text", r"(?:^|\n)Department\n([^\n]+)", None),
        ("tuition_home", "fee", None, ["Home fee", "UK fee", "Home:", "Home\nTuition fee"]),
        ("tuition_intl", "fee", None, ["Overseas fee", "International fee", "Overseas:"]),
        ("entry_req_text", "section", "Entry requirements|General entry requirements|Requirements",
         ["English language requirements|Fees and funding|Modules|Careers|Apply", "500"]),
        ("faculty", "name", None, None), ("language_band", "text", r"(?i)\bBand\s+([A-C])\b", ["band-", "upper"]), ("ielts", "ielts", None, None),
    ],
    ("bham", DETAIL): [
        ("name_en", "title", r"\s*-\s*University of Birmingham$", None), _UG_URL, ("entry_year", "url", r"\b(20\d{2})\b", None),
        ("ucas_code", "text", r"\nUCAS code\n([^\n]+)", None), ("campus", "text", r"\nCampus\n([^\n]+)", None),
        ("duration", "text", r"\nDuration\n([^\n]+)", None), ("entry_req_text", "section", "Entry requirements", [None, "700"]),
        ("faculty", "mention",
         "College of (?:Arts and Law|Engineering and Physical Sciences|Life and Environmental Sciences|Medicine and Health|Social Sciences)", None),
        ("dept", "department", None, None), ("tuition_home", "fee", None, ["UK/Ireland", "Home", "UK"]),
        ("tuition_intl", "fee", None, ["International", "Overseas"]), ("ielts", "ielts", None, None),
    ],
    ("shef", DETAIL): [
        ("name_en", "title", r"\s*\|\s*The University of Sheffield.*$", None), _UG_URL, ("entry_year", "url", r"/(20\d{2})/", None),
        ("duration", "raw", r"(?is)class=\"[^\"]*\bpgduration\b[^\"]*\"[^>]*>\s*([^<]+)", None),
        ("dept", "text", r"\b(School of [A-Z][A-Za-z &,\-]{3,80}|Management School|Information School)\b", None),
        ("entry_req_text", "section", "Entry requirements", [None, "800"]), ("ielts", "ielts", None, None),
    ],
    ("monash", DETAIL): [
        ("name_en", "next", "title", None), ("code", "next", "code", None), ("aqf", "next", "aqf_level.label", None),
        ("faculty", "next", "school.value", None), ("faculty", "next", "school", None), ("campus", "next", "location", None),
        ("years", "next", "full_time_duration[0].duration_number", None), ("currency", "const", "AUD", None),
    ],
    ("unsw", DETAIL): [
        ("name_en", "next", "title", None), ("code_prefix", "next", "code", None), ("level", "next_flag", "study_level", ["ugrd", "UG", "PGT"]),
        ("dept", "next", "academic_org.value", None), ("faculty", "next", "parent_academic_org.value", None),
        ("duration_n", "next", "duration_ft_min", None), ("duration_unit", "next", "duration_ft_period", None),
    ],
    ("uq", DETAIL): [
        ("name_en", "ld", r"\s*[-|]\s*(?:Study\s*[-|]\s*)?The University of Queensland.*$", ["Study", "The University of Queensland"]),
        ("name_en", "raw", r"<title>([^<|]+)", None), ("level", "name_level", None, None), ("currency", "const", "AUD", None),
    ],
    ("uwa", DETAIL): [
        ("name_en", "pair", "course title", None), ("name_en", "pair", "title", None), ("name_en", "h1", None, None),
        ("level", "url_flag", "majordetails", ["UG", None]), ("level", "pair_flag", "course type", ["(?i)bachelor|undergraduate", "UG", "PGT"]),
        ("faculty", "pair", "administered by", None),
    ],
    ("adel", DETAIL): [
        ("name_en", "document", r"^Study |\s*\|\s*Adelaide University$", None), ("level", "url_flag", r"/bachelor[^/]*/?$", ["UG", "PGT"]),
        ("code_prefix", "text", r"(?:^|\n)Program code\n([^\n]+)", None), ("duration", "text", r"(\d+(?:\.\d+)? year\(s\)[^\n]{0,30})", None),
    ],
    ("anu", DETAIL): [
        ("name_en", "document", r"\s*-\s*ANU$", None), ("level", "url", r"[?&]uaLevel=([A-Z]+)", None), ("level", "const", "PGT", None),
        ("code_prefix", "text", r"(?:^|\n)Academic plan\n([^\n]+)", None), ("dept", "text", r"(?:^|\n)Offered by\n([^\n]+)", None),
        ("faculty", "text", r"(?:^|\n)ANU College\n([^\n]+)", None), ("faculty", "text", r"(ANU College of [A-Z][A-Za-z,&\- ]{3,50})", None),
        ("duration", "text", r"(?:^|\n)Length\n([^\n]+)", None),
    ],
    # ---- module pages
    ("ucl", MODULES): [
        ("name_en", "h1", None, None), ("code", "url", r"-([A-Z]{4}\d{4})/?$", None), ("credits", "text", r"Credit value:?\s*\n(\d+)", None),
        ("level", "text", r"(FHEQ Level \d+)", None), ("leader", "text", r"Module leader:?\s*\n([^\n]+)", None),
        ("semester", "text_raw", r"(?:Intended t|T)eaching term:?\s*\n([^\n]+)", None), ("semester", "text_raw", r"Term:?\s*\n([^\n]+)", None),
        ("prerequisites", "text", r"(?:Module p|P)rerequisites?:?\s*\n([^\n]+)", None),
        ("description", "raw_text", r"(?is)class=\"[^\"]*\b(?:module-description|field--name-body)(?=[\s\"])[^\"]*\"[^>]*>(.*?)</div>", ["8000"]),
    ],
    ("monash", MODULES): [
        ("name_en", "next", "title", None), ("code", "next", "code", None), ("dept", "next", "school.value", None),
        ("credits", "next", "credit_points", None), ("semester", "next", "unit_offering[0].teaching_period.value", None),
    ],
    ("unsw", MODULES): [
        ("name_en", "next", "title", None), ("code", "next", "code", None), ("dept", "next", "academic_org.value", None),
        ("credits", "next", "credit_points", None),
    ],
    ("uq", MODULES): [
        ("name_en", "raw_text", r"(?is)<h1[^>]*>((?:(?!</h1>).)*?)\s*\([A-Z]{4}\d{4}\)\s*</h1>", None),
        ("code", "raw", r"(?is)<h1[^>]*>(?:(?!</h1>).)*?\(([A-Z]{4}\d{4})\)\s*</h1>", None),
        ("level", "text_flag", r"Course level\s*\n\s*(Undergraduate|Postgraduate)", ["Undergraduate", "UG", "PGT"]),
        ("credits", "text", r"(\d{1,2})\s+Duration\b", None), ("dept", "text", r"(?:Faculty|School)\s*\n\s*([A-Z][A-Za-z ,&]{4,45})", None),
    ],
    ("sydney", MODULES): [
        ("name_en", "h1_part", r"^\s*[A-Z]{2,4}\d{4}\s*:\s*(.+)", None), ("code", "h1_part", r"^\s*([A-Z]{2,4}\d{4})\s*:", None),
        ("credits", "text", r"Credit points\s+(\d+)\b", None), ("dept", "text", r"(School of [A-Z][A-Za-z ,&]{3,45})\s+Student Portal", None),
        ("semester", "url", r"/(20\d\d-[^/]*)/?$", None),
    ],
    ("adel", MODULES): [
        ("name_en", "document", r"\s*\|\s*Adelaide University$", None), ("code", "text", r"(?:^|\n)Area/Catalogue\n([^\n]+)", None),
        ("dept", "text", r"(?:^|\n)Course owner\n([^\n]+)", None), ("credits", "text", r"(?:^|\n)Unit value\n(\d+)(?=\n|$)", None),
        ("level_no", "text", r"(?:^|\n)Course level\n(\d+)(?=\n|$)", None), ("leader", "text", r"(?:^|\n)Course coordinator\n([^\n]+)", None),
    ],
    ("anu", MODULES): [
        ("name_en", "document", r"\s*-\s*ANU$", None), ("code", "text", r"(?:^|\n)Code\n([^\n]+)", None),
        ("dept", "text", r"(?:^|\n)Offered by\n([^\n]+)", None), ("credits", "text", r"(?:^|\n)Unit Value\n\D*(\d+)", None),
    ],
}

# ---- deadlines -----------------------------------------------------------------------------
# (school, category, audience, type, time, pattern, words that must stand nearby, note)
_STANDARD = [
    ("all", "equal_consideration", "18:00:00", r"(?i)UCAS[^\n]{0,120}?(\d{1,2} \w+ \d{4})", [], "UCAS 常规截止"),
    ("all", "application", "23:59:00", r"(?i)(?:application deadline|closing date)[^\n]{0,120}(\d{1,2} \w+ \d{4})", [], "课程页申请截止"),
]
DEADLINES = [
    *[(s, DETAIL, *rule) for s in ("kcl", "warwick") for rule in _STANDARD],
    ("ucl", DETAIL, "international", "application", "17:00:00",
     r"(?<!do not )require a visa:\s*\n?\d{1,2} \w{3,9} \d{4}\s*\n?–\s*\n?(\d{1,2} \w{3,9} \d{4})", [], "需签证申请者截止"),
    ("ucl", DETAIL, "home", "application", "17:00:00",
     r"do not require a visa:\s*\n?\d{1,2} \w{3,9} \d{4}\s*\n?–\s*\n?(\d{1,2} \w{3,9} \d{4})", [], "无需签证申请者截止"),
    ("ucl", DETAIL, "all", "equal_consideration", "18:00:00", r"UCAS[^\n]*\n?\s*Apply by\s*\n?\s*(\d{1,2} \w+ \d{4})", [], "UCAS 常规截止"),
    ("gla", DETAIL, "international", "application", "23:59:00", r"International & EU applicants\s*\n(\d{1,2} \w+ \d{4})", [], "国际/欧盟申请者截止"),
    ("gla", DETAIL, "home", "application", "23:59:00", r"Home applicants\s*\n(\d{1,2} \w+ \d{4})", [], "本土申请者截止"),
    ("edi", DETAIL, "all", "equal_consideration", "18:00:00", r"(?i)UCAS deadline:\s*(\d{1,2} \w+ \d{4})", [], "UCAS 常规截止"),
    ("man", DETAIL, "all", "equal_consideration", "18:00:00", r"(?i)UCAS[^\n]{0,120}?(\d{1,2} \w+ \d{4})", [], "UCAS 常规截止"),
    ("man", DETAIL, "all", "round", "23:59:00", r"(?i)Application received by\s+(\d{1,2} \w+ \d{4})", [], "分轮申请截止"),
    ("bristol", DETAIL, "all", "application", "23:59:00",
     r"(?i)(?:International|Overseas|Home|Application deadline)[:\s\n-]+(\d{1,2} \w+ 20\d{2})", [], "课程页申请截止"),
    ("leeds", DETAIL, "international", "application", "23:59:00", r"\b(\d{1,2} \w+ 20\d{2})\b", ["deadline", "international"], "国际申请截止"),
    ("edi", UG, "all", "equal_consideration", "18:00:00", r"(?i)(\d{1,2} January 20\d{2})\s*\nUCAS Equal consideration", [], "UCAS equal consideration date"),
    ("man", UG, "all", "equal_consideration", "18:00:00", r"(?i)(\d{1,2} January 20\d{2})\s*\nEqual consideration", [], "UCAS 常规截止"),
    ("man", UG, "all", "equal_consideration", "18:00:00", r"(?is)Equal consideration[^\n]{0,180}(\d{1,2} \w+ 20\d{2})", [], "UCAS 常规截止"),
    ("bristol", UG, "all", "equal_consideration", "18:00:00", r"\b(\d{1,2} \w+ 20\d{2})\b", ["ucas"], "UCAS 日期"),
    ("leeds", UG, "all", "equal_consideration", "18:00:00", r"\b(\d{1,2} \w+ 20\d{2})\b", ["ucas"], "UCAS 日期"),
]
# Table rows whose description column names a deadline: (school, phrases, type, audience).
# Audience 'visa' is international where the description speaks of a visa, else all.
DEADLINE_ROWS = [
    ("shef", ("deposit deadline",), "deposit", "international"),
    ("shef", ("applications close", "last date to apply"), "application", "visa"),
]

# ---- module references and lists -------------------------------------------------------------
# (school, category, page_re, scope_re, source, pattern, code_re, module_type, exclude_tag_re)
# source: link (pattern on the URL), items ('name (N credits)' list items, optional or core by the heading above),
# columns (table columns by header text: name, code; core where the last cell says mandatory), next_cell (name in the
# cell behind the link). scope_re: start of the opening tag of the elements looked into.
MODULE_RULES = [
    ("ucl", DETAIL, None, r"(?is)<[a-z]+[^>]*\bprog-modules-mandatory\b", "link",
     r"/module-catalogue/modules/", r"-([A-Z]{4}\d{4})/?$", "core", None),
    ("ucl", DETAIL, None, r"(?is)<[a-z]+[^>]*\bprog-modules-optional\b", "link",
     r"/module-catalogue/modules/", r"-([A-Z]{4}\d{4})/?$", "optional", None),
    ("gla", DETAIL, None, None, "items", None, None, None, None),
    ("shef", DETAIL, None, None, "items", None, None, None, None),
    ("man", DETAIL, None, None, "columns", "Title|Code", r"\b([A-Z]{4}\d{4,5})\b", None, None),
    ("bham", DETAIL, None, r"(?is)<[a-z]+[^>]*\bid=[\"'][^\"']*module", "link", r"program-and-modules-handbook", None, "core", None),
    ("uwa", DETAIL, None, None, "link", r"unitdetails\?code=([A-Z0-9]+)", r"code=([A-Z0-9]+)", "core", None),
    ("adel", DETAIL, None, None, "link", r"/study/courses/([a-z]{2,6}-\d{4}[a-z]*)/", r"/study/courses/([a-z]{2,6}-\d{4}[a-z]*)/", "core", None),
    ("gla", MODULES, r"/courselist/.*name=(?:School(?:\+|%20| )of|Adam(?:\+|%20| )Smith)", None, "link", r"/coursecatalogue/course/\?code=", r"[?&]code=([^&]+)", None, None),
    ("edi", MODULES, "/cx_sb_", None, "link", r"/cx[a-z]{2,6}\d{5}\.htm$", r"/cx([a-z]{2,6}\d{5})\.htm$", None, "not_delivered"),
    ("leeds", MODULES, "/ModuleSearch/results/", None, "next_cell", r"/Module/", r"^([A-Z]{2,6}\d{4}[A-Z]?)$", None, None),
    ("warwick", MODULES, "departments=", None, "next_cell", r"/modules/2025/", r"/([A-Z]{2,4}\d{2,4}[A-Z]?)-\d+(?:\.\d+)?/?$", None, None),
    ("bham", MODULES, "Action=getModuleList", None, "link", r"getModuleDetailsList(?!.*pgSubj=(?:null|&))", r"[?&]pgCrse=([^&]+)", None, None),
    ("uwa", CATALOG, "/units", None, "link", r"unitdetails\?code=", r"code=([A-Z0-9]+)", None, None),
]

# Programme pages with modules in running text: (school, heading, limit, pieces between, item, words that rule one out).
SECTION_MODULES = [
    ("bristol", r"(?:Programme|Course) structure|Units|Modules", 5000, None,
     r"([A-Z][A-Za-z0-9 ,:&'()/.-]{5,120}?)\s+[–-]\s+\d{1,3}\s+credits?", None),
    ("leeds", r"Course details and modules|Modules", 9000, r"\n| {2,}",
     r"(?i)^(.{5,120}?)\s+(?:[–-]|\()\s*(?:\d{1,3})\s+credits?\)?$", r"(?i)\b(year|semester|choose|select)\b"),
]
# Module lists of articles under headings: (school, page_re, headings, tail cut from them, patterns of the fields).
ARTICLE_MODULES = [
    ("kcl", "dept=", ("h2", "h3", "h4"), r"\s*Level \d+$", {
        "code": r"Module code:\s*\n?([0-9][A-Z]{3}[0-9A-Z]{3,6})", "level": r"Level:\s*\n?(\d)",
        "credits": r"Credit value:\s*\n?(\d{1,3})", "dept": r"Department:\s*\n?([^\n]+)", "semester": r"Semester:\s*\n?([^\n]+)",
    }),
]
# Deadlines in rounds: (school, page_re, header of the date column, audience, type, time, note before and behind the number).
DEADLINE_ROUNDS = [("edi", "/postgraduate-taught/", "application deadline", "all", "round", "23:59:00", "第 ", " 轮申请截止")]

# Links of unit pages that name programmes.
WARWICK_STUDY_RE = r"/study/(?:undergraduate|postgraduate)/courses[^/]*/[a-z0-9-]+/?(?:\?|$)"

# ---- page checks: (school, category, pattern that must still occur, label) --------------------
CHECKS = [
    ("gla", FACULTIES, "College of", "colleges"), ("edi", "china_page", "China", "china"), ("bristol", "china_page", "China", "china"),
    ("bristol", "language_req", r"\bProfile\s+[A-H]\b", "profiles"), ("leeds", "china_page", "China", "china"),
    ("kcl", UG, "deadline|UCAS", "ug"), ("kcl", PG, "deadline|UCAS", "pg"), ("kcl", "language_req", r"\bBand\s+[A-E]\b", "bands"),
    ("kcl", "china_page", "China|East Asia", "china"), ("warwick", UG, "deadline|UCAS", "ug"), ("warwick", PG, "deadline|UCAS", "pg"),
    ("warwick", "language_req", r"\bBand\s+[ABC]\b", "bands"), ("bham", "china_page", "China", "china"), ("man", "china_page", "China", "china"),
    ("bham", FACULTIES, "College of (?:Arts and Law|Engineering and Physical Sciences|Life and Environmental Sciences|Medicine and Health|Social Sciences)", "colleges"),
    ("shef", "china_page", "China", "china"),
    ("shef", FACULTIES, "Faculty of (?:Arts and Humanities|Engineering|Health|Science|Social Sciences)|International Faculty, CITY College", "faculties"),
]

# ---- term dates ---------------------------------------------------------------------------------
# Tables: (school, page_re, year_from, year_re, name_cell, date_cell, end_cell, min_cells, track rules)
# year_from: heading | text | url | caption. Cells count from 0; end_cell None = the date cell holds a range.
TERM_TABLES = [
    ("ucl", None, "heading", r"(20\d{2})-(\d{2})", 0, 1, None, 2),
    ("edi", None, "text", r"Academic year\s+(\d{4})/(\d{2})", 1, 0, None, 2),
    ("man", None, "heading", r"(\d{4})/(\d{2}) academic year", 0, 1, 2, 2),
    ("warwick", "examination_dates", "caption", r"(20\d{2})/(\d{2}) Exam Dates", 0, -1, None, 2),
]
TRACKS = [("ucl", "Education", "ioe"), ("ucl", "Pharmacy", "pharmacy")]

# Lines: (school, page_re, year_re, label_first, section_re, label_re, skip_re)
# A line that matches year_re opens a year; a dated line is an event named by its own label
# (text before ':' or before the first digit) or by the line before it.
TERM_LINES = [
    ("kcl", None, r"^(20\d{2})-(\d{2}) Academic Calendar", "colon", r"^Semester \d$", "(?i)^academic year$"),
    ("leeds", None, r"Academic year\s+(20\d{2})/(\d{2})", "before", r"(?i)^(Terms?|Semesters?|Examinations?|Resits?)$", None),
    ("warwick", None, r"^(20\d{2})/20(\d{2})$", "before", None, None),
    ("bham", None, r"\b(20\d{2})/(\d{2})\b", "own", None, None),
    ("unsw", None, r"^(20\d{2})$", "before", None, None),
]


def discovery_rows() -> Iterator[tuple]:
    for number, rule in enumerate(DISCOVERY):
        *head, options = rule
        yield (
            number, *head, options.get("first", False), options.get("clean", False), options.get("template"),
            options.get("careers"), options.get("note_re"), options.get("title"), options.get("freq", "monthly"),
            options.get("method", "html"), options.get("unwrap", False), options.get("canon"), options.get("suffix"),
            options.get("carry"), options.get("page_size"), options.get("value"), options.get("label"),
        )


DISCOVERY_SCHEMA = (
    "rule_no int, school string, category string, page_re string, page_not_re string, source string, scope_re string,"
    " target_re string, exclude_re string, to_category string, first_only boolean, clean boolean, template string,"
    " careers array<string>, note_re string, fixed_title string, crawl_freq string, fetch_method string, unwrap boolean,"
    " canon string, suffix string, carry string, page_size int, value_field string, label_field string"
)


def field_rows() -> Iterator[tuple]:
    for (school, category), entries in FIELDS.items():
        for rank, (field, source, pattern, args) in enumerate(entries):
            yield school, category, field, rank, source, pattern, args


FIELD_SCHEMA = "school string, category string, field string, rank int, source string, pattern string, args array<string>"
DEADLINE_SCHEMA = (
    "school string, category string, audience string, deadline_type string, at_time string, pattern string,"
    " nearby array<string>, note string"
)
MODULE_SCHEMA = (
    "school string, category string, page_re string, scope_re string, source string, pattern string, code_re string,"
    " module_type string, exclude_tag_re string"
)
CHECK_SCHEMA = "school string, category string, pattern string, label string"
