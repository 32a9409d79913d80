"""Patterns and word lists that decide what is found in the Korean manuals. All are parameters elsewhere."""

# --- fixed values -----------------------------------------------------------------------------
CODE = r"(?U)\b[A-H]\s*-\s*\d{1,2}(?:\s*-\s*(?:[A-Z]?\d{1,2}|[A-Z]))?\b"
PARENT_CODE = r"(?U)^[A-H]-\d{1,2}"
AMOUNT = r"(?U)\b(?:\d{1,3}(?:,\d{3})*|\d+)\s*(?:만원|원|억원)\b"
DOCUMENT = "[가-힣A-Za-z0-9·‧]+(?:등록증|신청서|증명서|확인서|위임장|동의서|허가증|면허증|추천서|공한|진단서|진술서|보증서|초청장)"
NOISE = r"(?U)[\s,.·:;()\[\]【】「」『』<>＜＞|/＼\-_]+"
REPEATED = "[가-힣]"
TABLE_OPEN = r"(?iU)<table\b"
TABLE_CLOSE = r"(?iU)</table>"

VALIDITY = (
    r"(?U)단수사증|복수사증|단·복수\s*사증|단·복수재입국허가|복수재입국허가|사증유효기간|유효기간\s*\d+\s*(?:개월|년|월|月)|유효기간\s*\d+\s*년\s*이내"
    r"|재입국허가\s*(?:면제|복수)|단·복수\s*비자|단수\s*비자|복수\s*비자|단수\b|복수\b"
)
SINGLE_STAY = (
    r"(?U)1회\s*부여|1회에\s*부여|체류기간\s*상한|체류기간의\s*상한|체류기간\s*\d+\s*(?:일|개월|년)|체류기간\s*[가-힣]*\s*\d+\s*(?:일|개월|년)\s*이내"
    r"|허용기간|허가기간|연장(?:허가)?\s*[:는]|\d+차\s*연장|체류기간\s*\d+일\s*\(|입국일로부터\s*\d+개월\s*미만"
)
TOTAL_STAY = (
    r"(?U)최장체류기간|총\s*체류기간|최대\s*\d+\s*(?:일|개월|년)|최장\s*\d+\s*(?:일|개월|년)|재임기간|공무수행기간|신분존속기간|여권\s*유효기간\s*범위|범위\s*내"
    r"|협정상의?\s*체류기간|법무부장관이\s*따로\s*정하는|근로계약기간|재직기간|연구기간|교육기간|공연추천기간|체류허가기간|체류허가\s*기간|재고용\s*특례"
)
PLAIN_PERIOD = r"(?U)^\d+\s*(?:일|개월|년)(?:\s*이내|\s*이하)?$"

TABLE_ROUTES = [
    ("score_table", "점수|배점|만점|점 ?이상|합격선"),
    ("quota", r"쿼터|허용인원|제재 ?기준|선발 ?인원|%|인원 ?\(|명 ?이내"),
    ("companion", "동반가족|동반 ?범위"),
    ("fees", "수수료 ?일람|수수료 ?표"),
]
TABLE_DEFAULT = "eligibility"
TABLE_LABEL = "[표]"

DIRECT = {
    "applicant_context": "situation",
    "target_persons": "target",
    "eligibility": "eligibility",
    "requirements": "eligibility",
    "procedure": "procedure",
    "fees": "fees",
    "restrictions": "restrictions",
    "exceptions": "exceptions",
    "obligations": "obligations",
    "score_criteria": "score_table",
    "quota_or_limit": "quota",
    "inviter_context": "inviter",
    "recommendation_or_approval": "recommendation",
}
DOCUMENT_SECTIONS = [("[공통서류]", "common_documents"), ("[필수서류]", "mandatory_documents"), ("[기타서류]", "other_documents")]
FLOW = ["prereq", "next_step", "companion", "keywords"]
REQUIRED_FIELDS = ["manual_type", "item_type", "section_title", "petition_type", "subsection_type"]
KINDS = {"visa": "사증", "stay": "체류"}

#: Final columns: internal name and the name in the published table, in order.
COLUMNS = {
    "visa_code": "비자코드",
    "parent_code": "상위코드",
    "manual_kind": "사증·체류",
    "petition_type": "신청종류",
    "situation": "신청상황",
    "target": "대상자",
    "eligibility": "자격요건",
    "procedure": "절차",
    "fees": "수수료",
    "visa_validity": "사증유효기간",
    "single_stay": "1회부여 체류기간",
    "total_stay": "체류상한",
    "restrictions": "제한",
    "exceptions": "예외",
    "obligations": "의무사항",
    "score_table": "점수표",
    "quota": "쿼터",
    "inviter": "초청자",
    "recommendation": "추천·승인기관",
    "documents": "제출서류",
    "expected_questions": "예상질문",
    "source": "출처",
    "prereq": "선행자격",
    "next_step": "다음단계",
    "companion": "동반가족",
    "keywords": "키워드",
}
#: Columns searched for page hits, in order; the eighth name of the list is no final column and never matches.
SEARCHED = ["eligibility", "situation", "documents", "procedure", "restrictions", "exceptions", "target"]
# --- end of fixed values ----------------------------------------------------------------------
