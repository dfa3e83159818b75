"""Labels, patterns and word lists that results must agree on, in order of evaluation."""

from __future__ import annotations


def _table(text: str) -> tuple[tuple[str, str], ...]:
    """Rows ``label :: pattern``; lines that begin with white space continue a pattern."""
    rows: list[list[str]] = []
    for line in text.strip("\n").split("\n"):
        if line[:1].isspace():
            rows[-1][1] += line.strip()
        else:
            label, _, pattern = line.partition(" :: ")
            rows.append([label, pattern])
    return tuple((a, b) for a, b in rows)


# ---- fixed values: ordered rule tables ----
EMPLOYMENT = _table(r"""
Full Time :: \bfull[\s\-]?time\b|\bvollzeit\b|\btemps\s+plein\b|\bjornada\s+completa\b|\bFTE\b
Part Time :: \bpart[\s\-]?time\b|\bteilzeit\b|\btemps\s+partiel\b|\bmedia\s+jornada\b
PRN :: \bPRN\b|\bas\s+needed\b|\bcasual\s+pool\b
Contract :: \bcontract(?:or|ual)?\b|\bfreelance\b|\bb2b\b|\bwerkvertrag\b
Temporary :: \btemporary\b|\btemp\b|\bfixed[\s\-]term\b|\bbefristet\b|\binterim\b|\bseasonal\b
Internship :: \bintern(?:ship)?\b|\bpraktikum\b|\bworking\s+student\b|\bwerkstudent\b|\bstage\b|\btrainee\b
Apprenticeship :: \bapprentice(?:ship)?\b|\bausbildung\b|\blehrstelle\b
Volunteer :: \bvolunteer\b|\behrenamt\b
Per Diem :: \bper\s+diem\b
""")
SENIORITY = _table(r"""
Executive :: \b(?:chief|c-level|cto|ceo|cfo|coo|ciso|president|vice\s+president|\bvp\b|managing\s+director|geschäftsführ)
Director :: \bdirector\b|\bhead\s+of\b|\bleiter(?:in)?\b
Manager :: \bmanager\b|\bsupervisor\b|\bteam\s+lead(?:er)?\b|\bforeman\b
Principal :: \bprincipal\b|\bstaff\s+engineer\b|\bdistinguished\b|\bfellow\b
Senior :: \bsenior\b|\bsr\.?\b|\bexperienced\b|\blead\b|\biii\b|\bexpert\b
Mid :: \bmid[\s\-]?level\b|\bii\b|\bintermediate\b
Junior :: \bjunior\b|\bjr\.?\b|\bentry[\s\-]?level\b|\bgraduate\b|\bassociate\b|\bi\b(?!\w)
Intern :: \bintern(?:ship)?\b|\bpraktikant\b|\btrainee\b|\bapprentice\b|\bstudent\b
""")
EDUCATION_TYPE = _table(r"""
Doctorate :: \bph\.?d\b|\bdoctoral\b|\bdoctorate\b|\bpromotion\b|\bmd\b|\bdnp\b|\bedd\b
Master :: \bmaster'?s?\b|\bm\.?sc\b|\bm\.?a\.?\b|\bmba\b|\bm\.?tech\b|\bmsn\b|\bmph\b|\bdiplom\b
Bachelor :: \bbachelor'?s?\b|\bb\.?sc\b|\bb\.?a\.?\b|\bb\.?tech\b|\bb\.?e\.?\b|\bbsn\b|\bundergraduate\s+degree\b
Associate Degree :: \bassociate'?s?\s+degree\b|\ba\.?a\.?s?\b(?=\s+degree)|\bfoundation\s+degree\b
Diploma :: \bdiploma\b|\bpolytechnic\b|\bhnd\b|\bhnc\b
Certification :: \bcertifi(?:ed|cation)\b|\blicens(?:e|ed|ure)\b|\bregistered\s+nurse\b|\brn\b|\blpn\b|\bcna\b
High School :: \bhigh\s+school\b|\bged\b|\bsecondary\s+school\b|\babitur\b|\bhaupt-?schulabschluss\b|\bmatric\b|\b10\+2\b
Vocational :: \bvocational\b|\bberufsausbildung\b|\bapprenticeship\b|\biti\b
""")
EDUCATION_STREAM = _table(r"""
Nursing :: \bnursing\b|\bnurse\b|\bbsn\b|\bmsn\b|\brn\b
Medicine :: \bmedicine\b|\bmedical\b|\bphysician\b|\bsurgery\b|\bclinical\b|\bpharmac
Engineering :: \bengineering\b|\bmechanical\b|\belectrical\b|\bcivil\b|\bb\.?tech\b|\bingenieur
Computer Science :: \bcomputer\s+science\b|\binformatics\b|\binformation\s+technology\b|\bsoftware\s+engineering\b|\binformatik\b
Business :: \bbusiness\s+admin|\bmba\b|\bcommerce\b|\bmanagement\s+studies\b|\bbetriebswirt
Finance :: \bfinance\b|\baccount(?:ing|ancy)\b|\bcpa\b|\bca\b(?=\s|$)|\beconomics\b
Law :: \blaw\b|\blegal\s+studies\b|\bjuris\b|\bllb\b|\bllm\b|\bjura\b
Education :: \beducation\b|\bteaching\b|\bpedagog|\bb\.?ed\b|\blehramt\b
Sciences :: \bbiology\b|\bchemistry\b|\bphysics\b|\bbiochem|\blife\s+sciences\b|\bnaturwissenschaft
Social Sciences :: \bsocial\s+work\b|\bpsychology\b|\bsociology\b|\blmsw\b|\blcsw\b|\bsozial
Allied Health :: \bphysical\s+therapy\b|\bphysiotherap|\boccupational\s+therapy\b|\bspeech\s+(?:therapy|language)\b|
    \bradiograph|\bsonograph|\bdpt\b|\brespiratory\s+(?:therapy|care)\b|\bdietetic|\bnutrition\b
Pharmacy :: \bpharmacy\b|\bpharm\.?d\b|\bpharmaceutical\s+sciences\b
Hospitality :: \bhospitality\s+management\b|\bculinary\b|\btourism\b
""")
JOB_CATEGORY = _table(r"""
Healthcare :: \bnurse\b|\bnursing\b|\bphysician\b|\bclinical\b|\bpatient\b|\bmedical\b|\btherapist\b|\bpharmac|\bradiolog|
    \bsurgical\b|\bcare\s+partner\b|\bcna\b|\bphlebotom|\bsonograph|\bdental\b|\bveterinar
Information Technology :: \bsoftware\b|\bdeveloper\b|\bprogrammer\b|\bdata\s+(?:engineer|scientist|analyst)\b|\bbackend\b|
    \bfrontend\b|\bfull[\s\-]?stack\b|\bdevops\b|\bsysadmin\b|\bit\s+support\b|\bnetwork\b|\bcloud\b|\bqa\b|\banalyst\b.*\bsystem
Engineering :: \bengineer\b|\bengineering\b|\bmechanic\b|\belectrician\b|\btechnician\b|\bmaintenance\b|\bwelder\b|\bmachinist\b|\bfitter\b
Sales :: \bsales\b|\baccount\s+(?:executive|manager)\b|\bbusiness\s+development\b|\bvertrieb\b
Marketing :: \bmarketing\b|\bbrand\b|\bseo\b|\bcontent\s+(?:writer|manager)\b|\bsocial\s+media\b|\bcommunications\b
Finance :: \baccount(?:ant|ing)\b|\bfinance\b|\bcontroller\b|\bauditor\b|\bpayroll\b|\btreasur|\bbookkeep
Human Resources :: \bhuman\s+resources\b|\bhr\b|\brecruit(?:er|ment)\b|\btalent\s+acquisition\b|\bpersonal(?:referent|wesen)\b
Legal :: \blegal\b|\battorney\b|\bcounsel\b|\bparalegal\b|\bcompliance\b|\bjurist
Operations :: \boperations\b|\blogistics\b|\bsupply\s+chain\b|\bwarehouse\b|\bdriver\b|\bproduction\b|\bmanufacturing\b|
    \bquality\s+(?:control|assurance)\b|\bplanner\b
Administration :: \badministrat|\bassistant\b|\bsecretar|\breception|\bclerk\b|\bscheduling\b|\boffice\s+manager\b|\bdata\s+entry\b|
    \bspecialist\b.*\bservice
Education :: \bteacher\b|\blecturer\b|\bprofessor\b|\btutor\b|\bfaculty\b|\binstructor\b|\berzieher
Customer Service :: \bcustomer\s+(?:service|support|success)\b|\bcall\s+cent|\bhelp\s?desk\b|\bguest\s+services\b
Research :: \bresearch\b|\bscientist\b|\blaborator|\bpostdoc\b|\bclinical\s+trial\b
Construction :: \bconstruction\b|\bcarpenter\b|\bplumber\b|\bsite\s+manager\b|\bsurveyor\b|\barchitect\b
Hospitality :: \bchef\b|\bcook\b|\bwaiter\b|\bhousekeep|\bhotel\b|\brestaurant\b|\bbarista\b|\bcatering\b
Retail :: \bretail\b|\bcashier\b|\bstore\s+(?:manager|associate)\b|\bmerchandis|\bverkäufer
Security :: \bsecurity\s+(?:officer|guard)\b|\bsurveillance\b|\bcorrections?\b|\bprobation\b
""")
# ---- fixed values: skills, in order of alternation ----
SKILLS = (
    r"python|java|javascript|typescript|c\+\+|c#|\.net|php|ruby|go(?:lang)?|rust|kotlin|swift|scala|perl|r\b|matlab|sql|mysql|postgresql|oracle|mongodb|redis|elasticsearch"
    r"|aws|azure|gcp|google cloud|docker|kubernetes|terraform|jenkins|git|linux|windows server|react|angular|vue|node\.?js|django|flask|spring|laravel|\.net core|power bi|tableau|excel"
    r"|sap|salesforce|servicenow|machine learning|deep learning|nlp|tensorflow|pytorch|etl|data warehouse|snowflake|databricks|spark|hadoop|airflow|rest api|graphql|microservices|ci/cd|agile|scrum|jira"
    r"|autocad|solidworks|revit|plc|scada|six sigma|lean|bls|acls|pals|epic|cerner|meditech|hipaa|icd-10|phlebotomy|iv insertion|wound care|telemetry|ventilator"
    r"|quickbooks|sap fico|ifrs|gaap|payroll|accounts payable|accounts receivable|financial modelling|financial modeling|procurement|contract negotiation|stakeholder management|project management|pmp|prince2"
    r"|budgeting|forecasting|seo|sem|google analytics|hubspot|crm|email marketing|customer service|conflict resolution|team leadership"
)
# ---- fixed values: leadership titles ----
NOT_OWNER = r"\b(?:process|product|service|data|risk|system|application|platform|feature|epic|story|control|capability|workflow|business\s+process|technical|solution)\s+owner\b"
LEADERS = (
    r"\b(ceo|cfo|coo|cto|cio|cmo|chro|ciso|cro|cpo|cdo)\b",
    r"\bchief\s+[a-z]+(\s+[a-z]+)?\s+officer\b",
    r"\b(president|founder|co-founder|owner|proprietor|managing\s+director|managing\s+partner)\b",
    r"\b(director|vice\s+president|vp|svp|evp|avp|head\s+of|general\s+manager)\b",
    r"\bchief\s+(technolog[a-z]*|information|digital|data|technical|security|innovation|product|ai|analytics)\s+(and\s+[a-z]+\s+)?officer\b",
)
LEADER_FIELDS = (
    r"\b(financ[a-z]*|account[a-z]*|controller|treasur[a-z]*|audit[a-z]*|tax|bookkeep[a-z]*|payroll|fp&a)\b",
    r"\b(operations?|operational|ops)\b",
    r"\b(procurement|purchas[a-z]*|sourcing|supply\s+chain|buyer|vendor\s+manage[a-z]*|category\s+manager)\b",
)
LEADER_LEVEL = r"\b(?:chief|director|vice\s+president|vp|svp|evp|avp|head\s+of|general\s+manager|senior\s+manager|principal|partner)\b"
# ---- fixed values: seniority buckets of the export ----
EXPORT_SENIORITY = _table(r"""
V-Level :: \bvice\s+president\b|\bvp\b|\bsvp\b|\bevp\b|\bavp\b
D-Level :: \bdirector\b|\bmanaging\s+director\b|\bmanaging\s+partner\b
H-Level :: \bhead\s+of\b|\bhead\b|\bgeneral\s+manager\b
M-Level :: \bsenior\s+manager\b|\bprincipal\b|\bpartner\b|\bsr\.?\s+manager\b
""")
EXPORT_C_LEVEL = r"\bchief\b|\b(ceo|cfo|coo|cto|cio|cmo|chro|ciso|cro|cpo|cdo)\b|\bpresident\b|\bfounder\b|\bowner\b|\bproprietor\b"
# ---- fixed values: employment and education labels of the export ----
EXPORT_EMPLOYMENT = (
    ("full time", "Full Time"), ("full-time", "Full Time"), ("fulltime", "Full Time"), ("regular", "Full Time"), ("part time", "Part Time"), ("part-time", "Part Time"),
    ("contract", "Contract"), ("contractor", "Contract"), ("temporary", "Contract"), ("fixed term", "Contract"), ("internship", "Internship"), ("intern", "Internship"),
    ("apprenticeship", "Apprenticeship"), ("permanent", "Permanent"), ("volunteer", "OTHER"), ("per diem", "OTHER"), ("prn", "OTHER"), ("seasonal", "Contract"),
)
EXPORT_EDUCATION = {"Bachelor": "Bachelor's Degree", "Master": "Master's Degree", "Vocational": "Vocational Training"}
# ---- fixed values: currencies, in order ----
CURRENCIES = "USD EUR GBP INR AUD CAD CHF JPY CNY SEK NOK DKK PLN BRL HKD SGD NZD ZAR CZK HUF MXN".split()
SYMBOLS = {"€": "EUR", "$": "USD", "£": "GBP", "¥": "JPY", "₹": "INR"}
# ---- fixed values: statuses ----
RETRYABLE = ("Unreachable", "Career Page Not Found", "Career Page Found - Extraction Unsupported", "Error")
JOB_STATUS = {"no_jobs": "No Jobs Found", "unsupported": "Career Page Found - Extraction Unsupported", "career_not_found": "Career Page Not Found", "unreachable": "Unreachable", "error": "Error"}
EXTRACTION_STATUS = {"no_jobs": "Explicit No-Openings Evidence", "unsupported": "Extraction Unsupported", "career_not_found": "Career Page Not Found", "unreachable": "Website Unreachable", "error": "Processing Error"}
HIGH_CONFIDENCE = ("jsonld", "microdata", "hrmanager-detail")
# ---- fixed values: columns of a job and of an output row ----
JOB_FIELDS = (
    "job_title job_category job_location posted_date application_deadline closed_date job_status extraction_status extraction_confidence extraction_evidence last_checked_at"
    " education_stream education_type education_qualification years_of_experience years_of_experience_min years_of_experience_max seniority_level employment_type skills"
    " description_language job_description job_description_clean job_url salary_disclosed salary min_salary max_salary currency source"
).split()
OUTPUT_COLUMNS = (
    "company_name country website career_page_url career_page_status career_page_discovery_method resolved_website website_discovery job_title job_category job_location posted_date"
    " application_deadline closed_date job_status extraction_status extraction_confidence extraction_evidence last_checked_at education_stream education_type education_qualification"
    " years_of_experience_min years_of_experience_max seniority_level employment_type skills description_language job_description job_description_clean job_url salary_disclosed salary"
    " min_salary max_salary currency source scraped_at num_positions"
).split()
# ---- fixed values: labelled fields (pattern up to its value, words that end the value) ----
LABELLED = {
    "employment_type": (r"(?:employment\s*type|job\s*type|type\s*of\s*employment|work\s*type|employment\s*tag|schedule)\s*[:\-]\s*", r"career\s*status|requisition|expected\s*travel|additional\s*locations|job\s*id|location|salary|compensation|education|qualification|experience|remote|#|$"),
    "seniority_level": (r"(?:career\s*status|seniority(?:\s*level)?|level|experience\s*level|career\s*level)\s*[:\-]\s*", r"requisition|expected\s*travel|additional\s*locations|employment\s*type|job\s*id|location|#|$"),
    "education_qualification": (r"(?:education(?:al)?\s*(?:qualification|requirement|level|type)?|qualification|degree\s*(?:requirement|level)?|minimum\s*qualification)\s*[:\-]\s*", r"requisition|experience|skills|job\s*id|location|#|$"),
    "years_of_experience": (r"(?:years?\s*of\s*experience|experience\s*(?:required)?|minimum\s*experience)\s*[:\-]\s*", r"requisition|education|skills|job\s*id|#|$"),
    "salary": (r"\b(?:salary|compensation|pay\s*range|annual\s*salary|pay|gehalt|vergütung)\b\s*[:\-]\s*", r"requisition|experience|education|job\s*id|#|$"),
}
# ---- fixed values: salary, experience and qualification patterns ----
SALARY_WORD = r"\b(?:salary|compensation|pay range|annual pay|gehalt|vergütung|brutto(?:jahres|monats)?gehalt|jahresbruttogehalt|monatsbruttogehalt|jahresbrutto|monatsbrutto|entlohnung)\b"
SALARY_AMOUNT = r"(?:[$€£₹¥]\s*\d|\d[\d.,]*\s*(?:[$€£₹¥]|USD|EUR|GBP|INR|AUD|CAD|CHF))"
SALARY_RANGE = r"(?:[$€£₹¥]|USD|EUR|GBP|INR|AUD|CAD|CHF|SEK|NOK|DKK|PLN|BRL)\s*\d[\d.,]{2,}\s*(?:k\b)?\s*(?:-|–|—|to|bis|até|a)\s*(?:[$€£₹¥]|USD|EUR|GBP|INR|AUD|CAD|CHF|SEK|NOK|DKK|PLN|BRL)?\s*\d[\d.,]{2,}\s*(?:k\b)?"
SALARY_RATE = r"(?:[$€£₹¥]\s*\d[\d.,]{2,}|\d[\d.,]{2,}\s*(?:USD|EUR|GBP|INR|AUD|CAD|CHF))\s*(?:per|/|p\.?a\.?|pro)\s*(?:hour|hr|year|annum|month|week|jahr|stunde|monat)"
YEARS_RANGE = r"\b(\d{1,2})\s*(?:-|–|—|to)\s*(\d{1,2})\s*(?:\+\s*)?years?\b"
YEARS_LEAST = r"(?:minimum(?: of)?|at least|more than|over)?\s*(\d{1,2})\s*\+?\s*years?(?:\s+of)?\s+experience|\b(\d{1,2})\s*\+\s*years?\b"
QUALIFICATION = r"((?:bachelor'?s?|master'?s?|associate'?s?|doctoral|ph\.?d|diploma|b\.?sc|m\.?sc|b\.?tech|m\.?tech|mba|bsn|msn|\brn\b|\blpn\b|high\s+school)[^.;\n]{0,90})"
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
NO_JOBS = (
    r"\b(?:no|not currently any|currently no)\s+(?:open\s+)?(?:positions|jobs|vacancies|openings)\b|\bwe (?:do not|don't) have any (?:openings|vacancies)\b"
    r"|\bingen ledige stillinger\b|\bkeine (?:offenen )?(?:stellen|stellenangebote)\b|\baucune offre d['’]emploi\b|\bno hay (?:vacantes|puestos disponibles)\b"
)
# ---- fixed values: what pages, links and titles look like ----
CLOSED = r"\b(position|job|role|vacancy|posting)\s+(?:is\s+)?(?:no longer available|closed|filled|expired)\b|\bapplications? (?:are )?closed\b|\bthis job has expired\b"
LISTING_ROOTS = ("", "/career", "/careers", "/jobs", "/vacancies", "/open-positions", "/opportunities", "/join-us", "/work-with-us")
PARKED = (
    r"domain\s+(?:is\s+)?for\s+sale|buy\s+this\s+domain|this\s+domain\s+is\s+parked|parked\s+(?:free\s+)?(?:at|by)|domain\s+(?:has\s+)?expired|renew\s+your\s+domain|under\s+construction|coming\s+soon|site\s+not\s+published"
    r"|future\s+home\s+of\s+something|default\s+web\s?site\s+page|apache2?\s+(?:ubuntu\s+|debian\s+)?default\s+page|welcome\s+to\s+nginx|iis\s+windows\s+server|account\s+suspended|bandwidth\s+limit\s+exceeded"
    r"|sedo\.com|hugedomains|godaddy\.com/domainsearch|afternic|dan\.com/buy-domain"
)
CAREER_WORDS = (
    r"career|careers|jobs?|join[\s_-]*us|joinus|join[\s_-]*(?:our[\s_-]*)?team|vacancies?|job-openings|open-positions|employment|working[-\s_]*(with|for|at)|work[-\s_]*with[-\s_]*us|we[-\s_]*are[-\s_]*hiring|hiring|job[s]?\b"
    r"|opportunit|stellenangebot|karriere|trabaj[aá]|empleo|offres[-\s]*d[’']emploi|emploi|recruit|recrut|praca|kariera|vagas|carreira|應聘|招聘|jobs\.?page"
)
EXCLUDED_LINK = r"javascript:|mailto:|tel:|#|\.(jpg|jpeg|png|gif|svg|css|js|pdf|zip|mp4|webp)|/wp-content/|/assets/|/static/|/img/|/images/|facebook|linkedin|twitter|instagram|youtube|\.xml$|\.json$|/feed|/api/|/login|/signup|/admin"
SOCIAL_HOST = r"(?:linkedin|facebook|twitter|instagram|youtube|tiktok|pinterest|wikipedia|indeed|glassdoor|monster|ziprecruiter|careerbuilder|xing|stepstone|naukri|wellfound|crunchbase|zoominfo|trustpilot|yelp|yellowpages|dnb\.com|dun\.com|bloomberg|reuters|britannica|google|bing|yahoo)\."
NON_BOARD_PATH = (
    r"/(?:legal|privacy(?:-\w+)*|terms|tos|cookies?|gdpr|dpa|imprint|impressum|about(?:-us)?|blog|news|newsroom|press|resources?|customers?|case-studies|pricing|plans|contact(?:-us)?|support|help|docs?|documentation|why-[\w-]+|products?|platform"
    r"|solutions?|partners?|integrations?|events?|webinars?|demo|request-demo|signup|sign-up|register|login|sign-in|security|status|trust|accessibility|sitemap|glossary|templates?|ebooks?|guides?)(?:/|$|\?|#)"
)
ASSET_URL = r"/servlet/|/download|/getfile|/attachment|/asset|/media/|/binaries/|/resource/|/export|/rss|/feed|[?&](?:action=download|module=AppInert|download=|attachment=|export=)|\.(?:pdf|docx?|xlsx?|pptx?|zip|rar|csv|jpe?g|png|gif|svg|ico|css|js|woff2?|ttf|mp4|mp3)(?:$|[?#])"
BOARDISH_PATH = r"/(?:jobs?|careers?|vacanc\w*|openings?|positions?|opportunit\w*|companies|company|apply|recruiting|recruitment|stellen|stellenangebote|karriere|emplois?|empleos?|vagas|o|j|p|search)(?:/|$|\?|#|\d)"
CDN_HOST = r"^(?:cdn\d*|static\d*|assets?|media|img|images|js|css|scripts?|fonts?|cdn-\w+|akamai\w*|cloudfront|edge)\."
AGGREGATOR_HOST = (
    r"(?:^|\.)(?:indeed|glassdoor|linkedin|monster|ziprecruiter|careerbuilder|simplyhired|snagajob|dice|totaljobs|reed|cv-library|jobsite|adzuna|stepstone|xing|naukri|hirist|shine|timesjobs|foundit|jobstreet|jobsdb|seek|jora|wellfound|angel"
    r"|welcometothejungle|jobteaser|vagas|catho|infojobs|computrabajo|bumeran|zonajobs|governmentjobs|schooljobs|teamworkonline|facebook|twitter|instagram|youtube|tiktok|pinterest)\."
)
GENERIC_HEADING = (
    r"^(?:recently\s+posted\s+jobs?|open\s+(?:positions?|roles?|jobs?)|job\s+openings?|current\s+(?:vacancies|openings?|opportunities)|latest\s+jobs?|all\s+jobs?|search\s+results?|vacancies|opportunities|careers?|join\s+us|work\s+with\s+us"
    r"|our\s+jobs?|available\s+positions?|browse\s+jobs?|jobs?|positions?|stellenangebote|offene\s+stellen|karriere)$"
)
ROLE_WORD = (
    r"\b(?:manager|director|engineer|developer|analyst|specialist|coordinator|assistant|administrator|technician|nurse|physician|therapist|officer|consultant|advisor|associate|supervisor|lead|head|clerk|accountant|designer|architect|scientist"
    r"|researcher|teacher|lecturer|professor|driver|operator|representative|agent|executive|intern|apprentice|receptionist|secretary|cashier|chef|cook|cleaner|guard|paramedic|pharmacist|dentist|surveyor|electrician|plumber|carpenter|welder)\b"
    r"|(?:mitarbeiter|fachkraft|fachangestellt|ingenieur|pflege|erzieher|sachbearbeit|assistenz|leitung|berater|verkäufer|techniker|kaufmann|kauffrau|helfer|arzt|ärztin)"
)
GENDER_MARK = r"\(\s*(?:m|w|d|f|x)(?:\s*[/|,\-]\s*(?:m|w|d|f|x)){1,}\s*\)"
# ---- fixed values: legal forms and fillers in names ----
NOISE = (
    "the and of for ltd llc gmbh inc corp co sa oy ab bv nv plc limited company group holding holdings srl ag kg sas spa pty pvt private sdn bhd ooo zao doo sro kft corporation ltda eirl cia sarl sl aps as oyj kk dba mbh"
    " gesellschaft societe sociedad societa compania companhia incorporated lp llp pc pa de del la le les das der die und et y e do da dos van von di al el sp z o spolka akcyjna zoo ltd. s.a. s.r.l. b.v. n.v. a.s."
    " branch office division subsidiary affiliate franchise"
).split()
