"""Fixed word lists. Their content must equal the published values, so they are stated as plain text."""

# Sentiment lexicon, one list per category.

POSITIVE = """
able advantage benefit beneficial best better bolster boost capable certain confidence confident create
creation definitive deliver delivery dependable desirable desired enhance enhanced enjoy excellent exceptional
expand expansion extraordinary favorable gain gained good greater grew grow growing growth high higher highest
improve improved improvement increase increased innovative leading opportunities opportunity outstanding
perfect pleased positive profit profitable profitability progress record robust solid strength strong stronger
strongest success successful successfully superior surpass surpassed top triumph up upside upward valuable win
winner
""".split()

NEGATIVE = """
abnormal adverse against aggravate alarm alarming antagonistic anxiety anxious bad breakdown challenge
challenging closed closure concern concerned concerns condition contracting contraction contrary crash crisis
critical criticism decline decreased decreasing deficit depression deteriorate deteriorating deterioration
difficult difficulty disadvantage disadvantageous disappoint disappointed disappointing disappointment
disaster doubt doubtful down downturn downturns downward drag drop dropped dropping fail failed failing
failure fall fallen falling fear fearful fears fluctuate fluctuating fluctuation headwind hurt hurting
inadequate impair impaired impairment indebtedness instability insufficient interference jeopardize lack
liquidate liquidation litigation lose losing loss losses lost low lower lowest negative negatively neglect
obstacle obstruction penalty plummet poor problem problematic problems resign resignation risk risks risky
severe severely shrink shrinking slowing slowdown slower sluggish suffer suffered suffering suspect suspension
terminate termination threat troubled turmoil unable uncertain uncertainty unfavorable unsuccessful
vulnerabilities vulnerability vulnerable weak weaken weakened weakening weakness worst worthless
""".split()

UNCERTAINTY = """
almost ambiguity ambiguous anticipate anticipates anticipating anticipation appear appeared appears
approximate approximately assume assumed assumes assuming assumption assumptions believe believed believes
cautious cautiously could crossroad doubt doubtful essentially estimate estimated estimates estimating
estimation estimations exposed exposure exposures fluctuate fluctuated fluctuates fluctuating fluctuation
fluctuations guess guessed guesses guessing hopefully if indefinite indefinitely indefiniteness indeterminable
indeterminate intend intended intending intends intention intentions likely may maybe might nearly normally
perhaps possible possibly potential potentially predict predictable predicted predicting prediction
predictions predictive predicts preliminary presumably presume presumed presumes presuming presumption
presumptions probabilistic probabilities probability probable probably random randomize randomized randomizes
randomizing randomly randomness risk risked riskier riskiest risking risks risky roughly rumor rumored rumors
seem seemed seeming seemingly seems should sometime sometimes somewhat somewhere speculate speculated
speculates speculating speculation speculations speculative speculatively suggest suggested suggesting
suggests suppose supposed supposedly supposes supposing tentative tentatively turbulence uncertain uncertainly
uncertainties uncertainty unclear unconfirmed undecided undefined undesignated unestablished unknown unlikely
unproved unproven unprovens unsure usually vague vaguely vagueness volatility vulnerable
""".split()

LITIGIOUS = """
abovementioned abrogate abrogated abrogates abrogating abrogation abrogations absolve absolved absolves
absolving accession accessions acquirees acquirors acquit acquits acquittal acquittals acquitted acquitting
adjourn adjourned adjourning adjournment adjournments adjourns adjudge adjudged adjudges adjudging adjudicate
adjudicated adjudicates adjudicating adjudication affidavit affidavits aforementioned aforenamed aforesaid
allegation allegations allege alleged allegedly alleges alleging amicus annulment annulments antitrust
antitrusts appeal appealable appealed appealing appeals appellant appellants appellate appellees appendices
appendix appurtenance appurtenances appurtenant arbitrability arbitral arbitrate arbitrated arbitrates
arbitrating arbitration arbitrational arbitrations arbitrative arbitrator arbitrators assignation assignations
assumable attestation attestations attorney attorneys beneficiaries
""".split()
LEXICON = {
    "positive": POSITIVE,
    "negative": NEGATIVE,
    "uncertainty": UNCERTAINTY,
    "litigious": LITIGIOUS,
}

# The public English stop-word list.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his
himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
that that'll these those am is are was were be been being have has had having do does did doing a an the and but if
or because as until while of at by for with about against between into through during before after above below to
from up down in out on off over under again further then once here there when where why how all any both each few
more most other some such no nor not only own same so than too very s t can will just don don't should should've now
d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn
isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won
won't wouldn wouldn't
""".split()

# Finance stop words added to the English list when whole texts are tokenised.
FINANCE_STOP_WORDS = """
company quarter year financial reported period fiscal results earnings reports press release corporation announces
announced today
""".split()

STOP_WORDS = list(dict.fromkeys(ENGLISH_STOP_WORDS + FINANCE_STOP_WORDS))

# Keyword topics for texts without a fitted topic model.
KEYWORD_TOPICS = {
    "Financial Performance": ["revenue", "profit", "earnings", "financial", "quarter", "growth", "income"],
    "Market Position": ["market", "share", "competition", "industry", "position", "leader"],
    "Product Development": ["product", "development", "innovation", "launch", "roadmap"],
    "Operations": ["operations", "production", "supply", "chain", "efficiency", "cost"],
    "Future Outlook": ["outlook", "guidance", "future", "expect", "forecast", "anticipate"],
}

# Words that mark a phrase as positive, else as negative.
POSITIVE_PHRASE_WORDS = ["growth", "increase", "exceeded", "strong", "pleased"]
NEGATIVE_PHRASE_WORDS = ["decline", "short", "challenge", "negative", "pressure"]
