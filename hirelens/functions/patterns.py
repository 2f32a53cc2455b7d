"""Regular expressions of the domain rules, in RE2 syntax.

Word boundaries there are those of ASCII words; `java()` writes them out, as
Java counts accented letters as word characters.
"""

from __future__ import annotations

# The phrases that count as evidence of a work setting.
ROLE_HYBRID = r"\b(?:hybrid (?:role|position|schedule|arrangement)|(?:role|position|work arrangement|workplace|schedule)\s*:? (?:is |will be |follows a |uses a |has a )?hybrid)\b"
RECURRING = r"\b(?:alternat(?:e|ing) weeks?|[1-5] days? (?:per|a|each) week|every (?:week|monday|tuesday|wednesday|thursday|friday)|fridays?)\b"
ROLE_OFFICE = r"\b(?:(?:role|position|job) (?:is |will be |requires? |must be )?(?:fully |100% )?(?:onsite|on-site|in[- ]office|office-based|in-person)|(?:work|working|based|be|required|report|reporting|performed) (?:fully |100% )?(?:onsite|on-site|in[- ]office|in[- ]person)|(?:onsite|on-site|in[- ]office|office-based|in[- ]person) (?:role|position|opportunity|attendance)|work location: ?in person|(?:consistent|regular) in-person (?:presence|attendance|engagement))\b"
ROLE_REMOTE = r"\b(?:(?:role|position|job) (?:is |will be |can be )?(?:fully |100% |primarily |predominantly )?remote|(?:role|position) is based remotely|remote (?:role|position|job|opportunity)|(?:you will|you can|you may|eligible to|will) work (?:remotely|from home)|work (?:location|arrangement): ?remote)\b|^(?:fully|100%) remote$"
AMBIGUITY = r"\b(?:(?:remote|hybrid|onsite|on-site|office-based|in[- ]person)(?:\s*[,;(]+\s*(?:(?:/|or)\s*)?|\s*(?:/|or)\s*)(?:remote|hybrid|onsite|on-site|office-based|in[- ]person)|(?:initially|temporarily|eventually|after training|subject to approval|depending on|may become|could become)[^.;]{0,65}(?:remote|hybrid|onsite|on-site|office-based)|(?:remote|hybrid|onsite|on-site|office-based)[^.;]{0,55}(?:subject to approval|depending on|after training)|(?:work(?:ing)? )?(?:remotely|from home) (?:for )?[1-5] days? (?:per|a|each) (?:month|quarter|year)|(?:work(?:ing)? )?(?:onsite|on-site|in[- ]office) (?:for )?[1-5] days? (?:per|a|each) (?:month|quarter|year)|[1-5] days? (?:onsite|on-site|in[- ]office) (?:per|a|each)? ?(?:month|quarter|year|monthly|quarterly|yearly))\b"
NEGATION = r"\b(?:(?:not (?:eligible for |available for |structured as a |structured as an |a |an )?|no |cannot |can not |not permitted to |does not (?:allow|offer|support) )(?:fully |100% )?(?:remote(?: work| position| role)?|work (?:remotely|from home)|hybrid)(?: or hybrid)?|(?:remote(?: work| working)?|working (?:remotely|from home)|work from home|hybrid(?: work)?)(?: [1-5] days? (?:per|a|each) week)? (?:(?:is |will be )?not |will not be )(?:available|allowed|permitted|offered|supported)(?: for this role)?)\b"
REMOTE_NEUTRAL = r"\b(?:(?:not (?:required|necessary|mandatory|obliged|expected) to |(?:does|do|will) not (?:require|need|mandate) (?:(?:you|employees|candidates) to )?)(?:work (?:remotely|from home)|be remote)|(?:work(?:ing)? from home|work(?:ing)? remotely|remote(?: work)?|wfh)(?: [1-5] days? (?:per|a|each) week)? (?:(?:is |will be )?not |will not be )(?:required|necessary|mandatory))\b"
OFFICE_NEGATION = r"\b(?:(?:not (?:an? )?|no |(?:does|do|will) not (?:require|need|mandate) (?:(?:(?:you|employees|candidates) to )?(?:work|be) |working )?|(?:is |are )?not (?:required|necessary|mandatory|obliged|expected) (?:to (?:work|be) )?)(?:onsite|on-site|in[- ]office)(?: (?:attendance|role|position|work))?|(?:work(?:ing)? |attendance )?(?:onsite|on-site|in[- ]office)(?: (?:attendance|work))?(?: [1-5] days? (?:per|a|each) week)? (?:(?:is |will be )?not |will not be )(?:required|mandatory|necessary|available))\b"
OFFICE_WEEK = r"\b(?:work(?:ing)? )?(?:onsite|on-site|in[- ]office)(?: in [a-z ]{1,35})? (?:for )?([1-4]) days?(?: (?:per|a|each) week| and [1-4] days? remotely)\b"
OFFICE_DAYS_LEAD = r"\b([1-4]) days? (?:onsite|on-site|in[- ]office)\b"
REMOTE_WEEK = r"\bwork (?:remotely|from home) (?:for )?([1-4]) days? (?:per|a|each) week\b"
REMOTE_TAIL = r"\b([1-4]) days? (?:remotely|remote)\b"
FRIDAY_HOME = r"\bwork from home (?:on )?fridays?\b"
OFFICE_LOGISTICS = r"[^.;]*\b(?:interviews?|interviewing|applications?|recruiting|recruitment|training|orientation|onboarding|conferences?|meetups?|team events?|company events?)\b[^.;]*"
OFFICE_SUBSTANTIVE = r"\b(?:(?:role|position|job) (?:is |will be |requires? |must be )?(?:fully |100% )?(?:onsite|on-site|in[- ]office|office-based|in-person)|(?:onsite|on-site|in[- ]office|office-based) (?:role|position|opportunity)|(?:work|working) (?:fully |100% )?(?:onsite|on-site|in[- ]office)|work location: ?in person|(?:consistent|regular) in-person (?:presence|attendance))\b"
OFFICE_LABEL_NEGATION = r"\b(?:not (?:an? )?|no )(?:office-based|in-person)(?: (?:role|position|attendance))?\b"
COMPANY_REMOTE = r"\b(?:we are|our company is|the company is) (?:a )?(?:fully|100%) remote (?:company|organization|business)\b"
COMPANY_HYBRID = r"\b(?:we|our company|the company) (?:operate|operates|follow|follows|use|uses) (?:in |on |under )?(?:a )?hybrid (?:work |working )?model\b"
COMPANY_GUARD = r"\b(?:not|no|if|may|might|could|depending|options?|offer|offers|benefits?)\b"
PHYSICAL_CARE = r"\b(?:(?:prepare|prepares|preparing) patients for (?:examination|treatment)|(?:room|rooms|rooming) patients|(?:administer|administers|administering|give|gives|giving) (?:medications, )?(?:injections|immunizations|vaccines)|(?:perform|performs|performing|assist|assists|assisting) (?:with )?(?:phlebotomy|blood draws|physical examinations|physical exams)|(?:conduct|conducts|conducting) (?:physical assessment|forensic exam)|(?:lift|lifting|transfer|transferring) patients|(?:provide|provides|providing)[^.;]{0,60}(?:direct patient care|nursing care)[^.;]{0,100}(?:hospital|inpatient|bedside|clinic))\b"
PHYSICAL_OPERATIONS = r"\b(?:(?:pilot|pilots|piloting|fly|flies|flying|operate|operates|operating) (?:an? |the )?(?:helicopter|aircraft|airplane)|(?:provide|provides|providing) medical air transportation|(?:perform|performs|performing|conduct|conducts|conducting) (?:pre-flight|post-flight|aircraft) inspections|(?:operate|operates|operating|maintain|maintains|maintaining|repair|repairs|repairing) (?:an? |the )?(?:forklift|lathe|cnc machine|production machinery|physical machinery|heavy equipment)|(?:escort|escorts|escorting|search|searches|searching|supervise|supervises|supervising|restrain|restrains|restraining|transport|transports|transporting) (?:inmates|detainees|prisoners))\b"
PHYSICAL_GUARD = r"\b(?:not|no|never|if|may|might|could|would|hypothetical|previous|prior|experience|knowledge|familiarity|training|trained|course|software|simulat[a-z]*|design|designing|designs|develop|developing|develops|virtual|telehealth|telemedicine|telephone|phone|video|online|remote|remotely|tele-?operated|tele-?operation)\b|\bour (?:company|clients?|customers?|teams?|organization|mission|hospitals?|hospital system|health system|clinics?|practices?|facilit(?:y|ies)|partners?|stores?|sites?)\b|\b(?:at|across|for|within) (?:our |the )?(?:partners?|clients?|hospitals?|clinics?|facilit(?:y|ies)|stores?|sites?)\b|\bteams? (?:that|who)\b|\bwe (?:provide|deliver)\b"

_BOUNDARY = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"


def java(pattern: str) -> str:
    """The pattern for java.util.regex, with the meaning it has in RE2."""
    return pattern.replace(r"\b", _BOUNDARY)
