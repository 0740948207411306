"""Word sets of the annotators, and readers for word files."""

from __future__ import annotations

import glob
import json
import os

# Words whose results must be the same everywhere.
DOSAGE_NUMBER = frozenset("one two three four five six seven eight nine ten one-half one-and-a-half one-and-a-half-tablets one-half-tablet one-fourth one-third half-tablet one-to-two two-to-three three-quarter three-quarters three-fourths one-quarter".split())
FORM = frozenset("cream creams patch patches tablet tablets capsules capsule caplets nebulizer supplementation supplement cap caps tabs tab aerosol elixir emulsion enema gel implant inhalant injection liquid lotion lozenge lozenges ointment packet packets pill pills powder shampoo soap unit units solution spray suppository syrup drop drops dl cl cc ml liter liters centiliter centiliters milliliter milliliters".split())
NUMERATOR = frozenset("one two three four five six seven eight nine ten".split())
DENOMINATOR = frozenset("half halfs third thirds fourth fourths fifth fifths sixth sixths seventh sevenths eighth eighths nineths nineth tenth tenths".split())
FREQUENCY = {"once": 1, "twice": 2, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9}
FREQUENCY_MIDDLE = frozenset("a an as in the each times time per every at x".split())
DAILY = frozenset("noon lunch breakfast dinner morning afternoon evening am pm a.m. p.m. q.a.m. q.p.m. a.m p.m q.a.m q.p.m bedtime specified day".split())
PER_DAY = frozenset("day qday 24-hours qd qn qhs daily nightly od q.d. q.d q.n. q.n q.h.s. q.h.s q.day o.d. o.d".split())
TWICE_A_DAY = frozenset("q12h q12 12h 12hr 12hrs q10-12h q10-12 q10h-12h 10-12h 10-12 10h-12h bid b.i.d. b.i.d".split())
THREE_A_DAY = frozenset("q8-12h q8-12 q8h-12h 8-12h 8-12 8h-12h tid t.i.d. t.i.d q8 q8h 8h 8hr 8hrs q4-8h q7-8h".split())
FOUR_A_DAY = frozenset("qid q.i.d. q.i.d q6 q6h qds 6h 6hr 6hrs q6-q8 6-q8h q6-8 q6-8h q5-q6 5-q6h 5-6h q5-6 q5-6h 5-6".split())
SIX_A_DAY = frozenset("q4-q6 4-q6h 4-q6hr 4-q6hrs 4-6h q4-6 q4-6h q4-6hr q4-6hrs q4 q4h 4h 4hr 4hrs".split())
OTHER_DAY = frozenset("every-other-day every-other-night every-other-evening every-other-morning".split())
OTHER_HOUR = frozenset("q2-q4 2-4h q2-4hr q2-4hrs 2-q4h q2-4 q2-4h".split())
PER_WEEK = frozenset("week weekly".split())
PRN = frozenset("prn p.r.n. p.r.n as-needed asneeded".split())
HOUR_SUFFIX, DAY_SUFFIX = frozenset("h hr hrs hour hours".split()), frozenset("d day daily".split())
WEEK_SUFFIX, MONTH_SUFFIX, YEAR_SUFFIX = frozenset("wk week weekly weeks".split()), frozenset("month months m mo".split()), frozenset("y year yr".split())
POST_FOUR, POST_SIX, POST_EIGHT = frozenset("five six seven eight nine".split()), frozenset("seven eight nine".split()), frozenset("nine ten".split())
DURATION_LEAD = frozenset("for until continue continued over and of x".split())
DURATION_MORE = frozenset("an a the next up about additional approximately".split())
DURATION_NUMBER = frozenset("one two three four five six seven eight nine ten eleven twelve half few couple once twice".split())
PERIOD = frozenset("year one-year years month months week weeks day days yr yrs mo wk mos wks".split())
MULTI_THEN = frozenset("then taper tapers tapered tapering".split())
SINGLE_START, FIRST_START = frozenset("started starting begin begins restart restarted start starts reinstitued".split()), frozenset("new admission reinstituted".split())
SINGLE_STOP, FIRST_STOP = frozenset("discontinued stopped ended finished held discontinue stopping ending stop stops end ends off quit".split()), frozenset("discontinued discontinue on past end".split())
SINGLE_INCREASE, FIRST_INCREASE = frozenset("increased increase".split()), frozenset("increase increases increased increasing".split())
SINGLE_DECREASE = frozenset("lower lowers lowered decreased decrease decreases reduce reduces reduced".split())
FIRST_DECREASE = frozenset("taper tapering tapered decrease decreased reduced reduce lower lowered".split())
SINGLE_NO_CHANGE, FIRST_NO_CHANGE, NO_CHANGE = frozenset("continued continue continues".split()), frozenset("continued alter altered future".split()), frozenset(["no"])
CHANGE_WORD, SINGLE_SUM = frozenset("change changed".split()), frozenset()
SINGLE_MAX, FIRST_MAX, SECOND_MAX = frozenset("maximum max total totaling".split()), frozenset("maximum max total".split()), frozenset(["of"])
SECOND_DUAL = frozenset("medications dose dosage dosages medication psychotropic taper tapering to complete completed".split())
SECOND_FROM, SECOND_OFF = frozenset(["from"]), frozenset("off stop hold discontinue discontinued".split())
CONFIRMED_BEGIN, CONFIRMED_NEXT = frozenset("new dose reinstituted continue prn continued".split()), frozenset("adjustment dose dosage dosages adjustments medication medications".split())
HISTORY_BEGIN, HISTORY_MIDDLE, HISTORY_NEXT = frozenset("discontinued discontinue past recently medication radiology food".split()), frozenset("psychotropic discontinued on".split()), frozenset("medication medications hold".split())
PROBABLE_BEGIN, PROBABLE_NEXT = frozenset("taper tapered changed altered alter patient".split()), frozenset("medication medications take".split())
PROBABLE_MIDDLE, PROBABLE_END = frozenset("and may".split()), frozenset("discontinued discontinue".split())
TEXT_SUFFIX = frozenset("gtts ui iu meq mcg gr tsp tbsp g mg dl cl ml kg cc ou".split())
ROUTE_MIDDLE = frozenset("a an as by the via tube in".split())
INJECT = frozenset("subcutaneously intervenous intervenously injection injections injected iv intravenous intravenously".split())
ORAL = frozenset("po p.o. p.o mouth orally oral".split())
RECTAL = frozenset("rectally anally pr p.r. p.r".split())
TOPICAL = frozenset("drop drops skin cream creams pv p.v. p.v topically topical vaginally".split())
GASTRIC, NEBULIZED, TRANSDERMAL = frozenset("gastric duodental".split()), frozenset("nebulizer nebulizers neb".split()), frozenset(["transdermal"])
STRENGTH_NUMBER = frozenset("one two three four five six seven eight nine".split())
STRENGTH_UNIT = frozenset("micrograms microgram teaspoon teaspoons tablespoon tablespoons gram grams centigram centigrams milligram milligrams grain grains puffs puff unit units gtts ui iu meq mcg gr gm tsp tbsp g mg ou".split())
MONTHS = "january february march april may june july august september october november december".split()
NEG_VERB = frozenset("deny denies denied denying fail fails failed failing decline declines declined declining exclude excludes excluding excluded".split())
NEG_COLLOC = frozenset("rule rules ruled ruling rule-out".split())
NEG_PARTICLE = frozenset("not n't 't".split())
MODAL = frozenset("can ca will must could would should shall did".split())
REG_VERB = frozenset("reveal reveals revealed revealing have had has feel feels felt feeling complain complains complained complaining demonstrate demonstrates demonstrated demonstrating appear appears appeared appearing caused cause causing causes find finds found discover discovered discovers".split())
NEG_DET, NEG_PREP, NEG_ADJ = frozenset("no any neither nor never".split()), frozenset("without absent none".split()), frozenset("unremarkable unlikely negative no unclear".split())
REG_NOUN = frozenset("evidence indication indications sign signs symptoms symptom sx dx diagnosis history hx findings".split())
BOUNDARY = frozenset("but however nevertheless notwithstanding though although when how what which while since then i he she they we ; . )".split())
SMOKER = tuple("smoke smokes smoked smoking smoker tobacco tobaccos tob nicotine cigar cigars cig cigs cigarette cigarettes".split())
NON_SMOKER = tuple("non-smoker nonsmoker non-smoking nonsmoking".split())
SMOKING_KNOWN = frozenset("smoker smoking smoke smokes smoked ex-smoker exsmoker non-smoker nonsmoker non-smoking nonsmoking tob tobacco tobaccos nicotine cigar cigars cig cigs cigarette cigarettes".split())
SMOKING_CONTRADICTION = frozenset("quit quits stop stops stopped discontinue discontinues discontinued".split())
SMOKING_GO_WORDS = tuple(
    "tried history_of will ago quitting smoking nicotine_patch smoked continued_to previous has_discontinued previously prior ex-smoker encouraged years has_quit month stops day refraining former past zyban days_ago to_stop remote discussed quit stop tobacco refrain currently years_ago smokes discontinued history exsmoker days smoker when months smoking_history yrs_ago used_to stopped continues_to nicotine discontinues yrs discontinuing was_smoker distant week is_smoker to_discontinue to_refrain discontinue refrained current wellbutrin still refrains while stopping has_stopped weeks_ago was use_to smoking_sensation quits year to_quit smoking_cessation continue_to weeks year_ago counselled is smoke months_ago".split()
)
SMOKING_STOP_WORDS = frozenset("a an the".split())
SMOKING_BOUNDARY = BOUNDARY | {"if"}
NOT_RARE = frozenset(
    "about across after against all along and any around at away back before behind below beneath beside besides between beyond both but by can concerning could down during eight except five for forward four from half he hers his how however i in inside into it its like may might mine must my near nine none nor of off on one or our ours out outside over past seven she should since six so some ten that the theirs there these this those three through throughout to toward twice two under until up upon what whatever when whenever where wherever which whichever who whoever whom whomever will with without would yet you yours zero".split()
)
SEMANTIC = (
    ("drug", "T053 T109 T110 T114 T115 T116 T118 T119 T121 T122 T123 T124 T125 T126 T127 T129 T130 T131 T195 T196 T197 T200 T203".split()),
    ("problem", "T019 T020 T037 T047 T048 T049 T050 T190 T191".split()),
    ("symptom", "T033 T040 T041 T042 T043 T044 T045 T046 T056 T057 T184".split()),
    ("procedure", "T060 T061".split()),
    ("activity", "T058".split()),
    ("lab", "T034 T059 T201".split()),
    ("anatomy", "T021 T022 T023 T024 T025 T026 T029 T030".split()),
)
MENTION = {"drug": "MedicationMention", "problem": "DiseaseDisorderMention", "procedure": "ProcedureMention", "anatomy": "AnatomicalSiteMention", "lab": "LabMention", "activity": "ActivityMention", "symptom": "SignSymptomMention"}


# Tables built from a rule.
_ONE_TO_TEN = "one two three four five six seven eight nine ten".split()
#: two-four, two-to-four and so on.
HYPHENATED_RANGE = frozenset(f"{a}{j}{b}" for i, a in enumerate(_ONE_TO_TEN) for b in _ONE_TO_TEN[i + 1 :] for j in ("-", "-to-"))
_EVERY = ["-a-day", "-a-week", "-daily", "-weekly", "-monthly", "-hourly", "-nightly", "-every-day", "-every-week", "-every-hour"]
#: once-daily, three-a-week, four-times-a-day and so on, with their number.
HYPHENATED_FREQUENCY = {
    **{f"{w}{e}": n for n, w in ((1, "once"), (2, "twice")) for e in _EVERY},
    **{f"{w}{e}": n for n, w in enumerate(_ONE_TO_TEN[:9], 1) for e in ("-a-day", "-a-week", "-a-month", "-an-hour")},
    **{f"{w}-time{'s' * (n > 1)}{e}": n for n, w in enumerate(_ONE_TO_TEN[:9], 1) for e in ("-a-day", "-a-week", "-a-month", "-each-hour")},
    **{f"{w}-time{'s' * (n > 1)}": n for n, w in enumerate(_ONE_TO_TEN, 1)},
}
#: one-day, few-weeks and so on.
DURATION_COMBINED = frozenset(f"{w}-{u}{'s' * (w not in ('one', '1'))}" for w in [*_ONE_TO_TEN[:9], "half", "few", "couple"] for u in ("day", "week", "month")) | frozenset(f"{n}-week{'s' * (n > 1)}" for n in (1, 2, 3, 4, 5, 7, 8)) | frozenset(f"{w}-a-{u}" for w in ("once", "twice") for u in ("day", "week", "month")) | {"1-month", "2-months"}


def read_words(path: str, drop_unterminated: bool = False) -> list[str]:
    """Lines of a word file in order, lower-cased. A missing file gives an empty list."""
    try:
        with open(path, encoding="utf-8") as f:
            text = f.read()
    except OSError:
        return []
    lines = text.split("\n")
    if drop_unterminated or not lines[-1]:
        lines = lines[:-1]
    return [x.strip().lower() for x in lines if x.strip()]


def read_pairs(path: str) -> dict[str, str]:
    """``key|value`` lines; a later key wins."""
    return dict(x.split("|", 1) for x in read_words(path) if "|" in x)


def read_rules(path: str) -> list[tuple[str, str]]:
    """Ordered ``suffix|replacement`` rules; any other number of columns is an error."""
    out = []
    for n, x in enumerate(read_words(path), 1):
        p = x.split("|")
        if len(p) != 2:
            raise ValueError(f"{path}: line {n} has {len(p)} columns")
        out.append((p[0], p[1]))
    return out


def read_token_counts(path: str) -> dict[str, int]:
    """``token:count`` lines; malformed ones are skipped."""
    out = {}
    for x in read_words(path):
        token, _, n = x.rpartition(":")
        if token and n.strip().lstrip("-").isdigit():
            out[token] = int(n)
    return out


def read_word_sets(folder: str) -> dict[str, frozenset[str]]:
    """All ``*.txt`` of a folder by file name."""
    return {os.path.splitext(os.path.basename(p))[0]: frozenset(read_words(p)) for p in sorted(glob.glob(os.path.join(folder, "*.txt")))}


def read_model(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


#: The units file of the survey (S8) as a whole, and mm/hr.
LAB_UNITS = frozenset(read_words(os.path.join(os.path.dirname(os.path.abspath(__file__)), "lab_units.txt")))
#: The published CRF of laboratory values.
LAB_CRF = os.path.join(os.path.dirname(os.path.abspath(__file__)), "lab_crf.json")
