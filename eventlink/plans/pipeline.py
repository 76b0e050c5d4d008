"""The cohort -> admissions -> linkage -> exclusions -> label plan over the
fixture views (the reference's EHR path, §3 Entry 1), one lazily built
DataFrame per stage.  Stages are plain DataFrames: Catalyst sees one plan per
query, prunes the columns each query does not need and pushes the type and
date filters into the parquet scans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import group_code, not_sentinel
from ..operators import attributes, codes, events, features, ranks
from ..session import materialize
from ..sources.tables import Fixtures

# Administrative censoring window of the fixture data.
CENSOR_LO = "1995-01-01"
CENSOR_HI = "2000-12-31"
HORIZON_DAYS = 30
DRG_MIN_SHARE = 0.01

# Variable selections (column -> C categorical / N numeric).
AREA_SELECTION = {"AREA_CLASS": "C", "AREA_RANK": "N", "AREA_SHARE": "N"}
# Several area tables by (schema, table): the fixture view and its selection.
AREA_TABLES = {
    ("ACS", "ACS_2019"): ("fx_acs", {"MED_INCOME": "N", "PCT_POV": "N"}),
    ("ADI", "ADI_2020"): ("fx_adi", {"ADI_NATRANK": "C", "ADI_STATERNK": "N"}),
    ("FARA", "FARA_2019"): ("fx_fara", {"LILA_FLAG": "C"}),
    ("MUA", "MUA_MO"): ("fx_mua", {"MUA_TYPE": "C"}),
    ("RUCA", "RUCA_2010"): ("fx_ruca", {"RUCA1": "C", "RUCA2": "N"}),
    ("SLD", "SLD_2021"): ("fx_sld", {"WALK_INDEX": "N"}),
    ("SVI", "SVI_CT_2020"): ("fx_svi", {"EP_POV": "N", "PCT_POV": "N"}),
}
PERSON_SELECTION = {"H_SEGMENT": "C", "H_OWN_RENT": "C", "H_FLAG": "C", "H_LENGTH": "N", "H_VALUE": "N",
                    "H_OWN_PREC": "C"}
BASE_CATEGORICAL = ["discharge_status", "sex", "race", "hispanic", "cci_class", "drg_regrp"]
BASE_NUMERIC = ["los", "age_at_enc", "obes", "cci", "ip_cumcnt_12m"]
BASE_COLUMNS = ["rowid", "patid", "ctx_id", "encounterid", "label", "ip_cumcnt_12m", "los", "discharge_status",
                "ed_ind", "age_at_enc", "sex", "race", "hispanic", "obes", "cci", "cci_class", "drg_regrp"]
ROW_COLS = ["rowid", "patid", "encounterid", "label"]


def coverage_flags():
    b = F.col("raw_basis")
    return {"DUAL_ELIG": b == "DUAL", "LIS_ELIG": b == "LIS",
            "DUAL_LIS_ELIG": b.like("DUAL%") | b.isin("DUAL", "LIS")}


class Pipeline:
    def __init__(self, fx: Fixtures, materialize_stages: bool = True, skew_safe: bool = True):
        self.fx = fx
        self.materialize_stages = materialize_stages
        # Person-keyed sequence steps without a person-keyed window (one person
        # may hold a large share of all events).
        self.skew_safe = skew_safe

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        # Linked events feed five downstream branches (exclusions, planned keys,
        # persons, labels); writing them once keeps each branch from re-running
        # the scan -> join -> window plan.
        return materialize(df, name) if self.materialize_stages else df

    # Diagnosis and procedure facts are joins of the two largest tables, read by
    # their dictionaries, both exclusions, the history score and the obesity onset:
    # each is written once, and so are its distinct codes, which dictionaries and
    # mappings read, and the small dictionaries over them, whose size then lets Spark
    # plan the joins without shuffling the facts.
    def _kept(self, name: str, over: str | None = None) -> DataFrame:
        if over is not None:
            self._codes(over)
        return self.fx.keep(name, self._stage)

    def _codes(self, name: str) -> DataFrame:
        self._kept(name)
        return self.fx.codes(name, self._stage)

    def _both_facts(self) -> None:
        # What reads diagnoses and procedures takes both from one join.
        if self.materialize_stages:
            self.fx.keep_lines()

    # -- C1 / admissions ------------------------------------------------------
    @cached_property
    def encounters(self) -> DataFrame:
        return self.fx.fx_encounter.withColumn("drg", group_code("grp_code"))

    @cached_property
    def span(self) -> DataFrame:
        cov = self.fx.fx_coverage.select("patid", F.col("cov_start").alias("start"), F.col("cov_end").alias("end"))
        enc = self.encounters
        ev_day = F.coalesce("discharge_date", "admit_date")
        enc_span = (enc.filter(not_sentinel("enc_type"))
                    .select("patid", ev_day.alias("start"), ev_day.alias("end")))
        return events.coverage_span([cov, enc_span], lo=CENSOR_LO, hi=CENSOR_HI)

    @cached_property
    def death(self) -> DataFrame:
        return (self.fx.fx_death.filter(F.col("death_date").between(F.lit(CENSOR_LO).cast("date"),
                                                                    F.lit(CENSOR_HI).cast("date")))
                .groupBy("patid").agg(F.max("death_date").alias("death_date")))

    @cached_property
    def admit(self) -> DataFrame:
        enc = self.encounters.select("patid", "encounterid", "enc_type", "drg", "admit_date", "discharge_date",
                                     "discharge_status", "discharge_disposition", "provider_id")
        return events.admissions(self.cohort, enc, self.death)

    @cached_property
    def cohort(self) -> DataFrame:
        # Read by the admissions, the base and the obesity onset.
        return self._stage(self.cohort_once, "cohort")

    @property
    def cohort_once(self) -> DataFrame:
        fx = self.fx
        return events.build_cohort(fx.fx_person, self.span, fx.fx_crosswalk, fx.fx_measure).select(*COHORT_COLUMNS)

    # -- C3 / C4 --------------------------------------------------------------
    @cached_property
    def linked(self) -> DataFrame:
        return self._linked()

    @cached_property
    def linked_carrying(self) -> DataFrame:
        """With the next event's type, DRG and provider, which no later step reads."""
        return self._linked(["enc_type", "drg", "provider_id"])

    def _linked(self, carry: list[str] | None = None) -> DataFrame:
        # Whole rows are written and shuffled for the link, the lookback, the exclusions
        # and the labels: they hold what is read behind them and nothing else.
        carry = carry or []
        read = [c for c in LABEL_COLUMNS if c not in LINK_COLUMNS + LOOKBACK_COLUMNS]
        # read by the sampling, the linking and the lookback
        admit = self._stage(self.admit.select(*dict.fromkeys([*read, "censor_date", "death_date", *carry])), "admit")
        l = events.link_next_event(admit, carry=carry, skew_safe=self.skew_safe)
        leads = [f"{c}_lead" for c in ("admit_date", *carry)] if carry else []
        l = l.select(*read, *LINK_COLUMNS, *leads)
        return self._stage(events.lookback_count(l, history=admit), "linked")

    # -- C5 / C6 / C7 ---------------------------------------------------------
    # Codes are mapped before the facts are cut to linked events: that takes no
    # shuffle, and few facts are left to meet the events once the lists are through.
    @cached_property
    def dx_grp(self) -> DataFrame:
        pdx = self._kept("fx_dx").filter(F.col("pdx") == "P")
        return codes.group_dx(pdx, self._kept("fx_dict10", "fx_dx"), self._kept("fx_dict9", "fx_dx"))

    @cached_property
    def px_grp(self) -> DataFrame:
        return self._px_grp()

    def _px_grp(self, only: DataFrame | None = None) -> DataFrame:
        return codes.group_px(self._kept("fx_px"), self.fx.fx_ranges, self._kept("fx_pxdict9", "fx_px"),
                              self._kept("fx_pxdict10", "fx_px"), keep=self._stage, codes=self._codes("fx_px"),
                              only=only)

    @cached_property
    def index_keys(self) -> DataFrame:
        ex = self.fx.fx_excl.filter(F.col("list") == "index")
        return codes.exclude_by_group(self.linked, self.dx_grp, ex, carry=["excl_type"])

    @cached_property
    def planned_keys(self) -> DataFrame:
        self._both_facts()
        ex = self.fx.fx_excl.filter(F.col("list") == "planned")
        px_ex = ex.filter(F.col("code_kind") == "px")
        by_px = codes.exclude_by_group(self.linked, self._px_grp(px_ex), px_ex)
        by_dx = codes.exclude_by_group(self.linked, self.dx_grp, ex.filter(F.col("code_kind") == "dx"))
        return by_px.unionByName(by_dx).distinct()

    # -- C8 -------------------------------------------------------------------
    def labelled(self, planned: str = "downgrade") -> DataFrame:
        self._both_facts()
        return events.eligible_readmissions(self.linked, self.index_keys, self.planned_keys,
                                            horizon=HORIZON_DAYS, planned=planned)

    @cached_property
    def eligible(self) -> DataFrame:
        # Read by the history score, the DRG regrouping and the base.
        return self._stage(self.labelled("downgrade"), "eligible")

    # -- C12 / C13 / C14 ------------------------------------------------------
    @cached_property
    def area_long(self) -> DataFrame:
        return attributes.attach_area(self.fx.fx_person_geo, {"AREA": self.fx.fx_area}, AREA_SELECTION)

    @cached_property
    def person_long(self) -> DataFrame:
        return attributes.attach_person(self.fx.fx_crosswalk, {"PERSON": self.fx.fx_person_attr}, PERSON_SELECTION)

    @cached_property
    def area_num(self) -> DataFrame:
        return attributes.encode_long(self.area_long, id="ctx_id", keys=["geocode"])

    @cached_property
    def flags(self) -> DataFrame:
        return attributes.flag_attributes(self.fx.fx_person, self.fx.fx_coverage, coverage_flags())

    @cached_property
    def person_num(self) -> DataFrame:
        return attributes.encode_long(self.person_long, id="patid").unionByName(self.flags)

    # The same for the persons with an eligible event alone.
    @cached_property
    def eligible_persons(self) -> DataFrame:
        return self.fx.fx_crosswalk.join(self.eligible.select("patid"), "patid", "left_semi")

    @cached_property
    def eligible_areas(self) -> DataFrame:
        people = self.eligible_persons.join(self.fx.fx_person_geo, "ctx_id").select("patid", "block_group")
        return attributes.attach_areas(people, {k: self.fx.get(view) for k, (view, _) in AREA_TABLES.items()},
                                       {k: chosen for k, (_, chosen) in AREA_TABLES.items()})

    @cached_property
    def eligible_person_num(self) -> DataFrame:
        long = attributes.attach_person(self.eligible_persons, {"PERSON": self.fx.fx_person_attr}, PERSON_SELECTION)
        flags = attributes.flag_attributes(self.eligible, self.fx.fx_coverage, coverage_flags())
        return attributes.encode_long(long, id="patid").unionByName(flags)

    # -- C10 / C15 / M12 ------------------------------------------------------
    @cached_property
    def history(self) -> DataFrame:
        return codes.history_score(self._kept("fx_dx"), self.fx.fx_prefix_dict, self.eligible, keep=self._stage,
                                   codes=self._codes("fx_dx"))

    @cached_property
    def drg_groups(self) -> DataFrame:
        return features.freq_regroup(self.eligible, "drg", min_share=DRG_MIN_SHARE)

    @cached_property
    def first_measure(self) -> DataFrame:
        # The cohort has it of every person with an event.
        return self.cohort.select("patid", "first_value", "first_date").filter(F.col("first_date").isNotNull())

    @cached_property
    def obesity(self) -> DataFrame:
        return features.obesity_onset(self.first_measure, self._kept("fx_dx"))

    @cached_property
    def base(self) -> DataFrame:
        b = features.analytic_base(self.eligible, self.cohort, self.fx.fx_person_alt, self.history, self.obesity,
                                   self.drg_groups, with_id=False)
        # One row per (person, event), so the dense rank is the row position:
        # numbering the rows writes the base once with its ids (no distinct,
        # no join back).
        if self.materialize_stages:
            b = ranks.numbered_rows(b, ["patid", "encounterid"], "rowid")
        else:
            b = ranks.surrogate_id(b, ["patid", "encounterid"], "rowid", persist=False)
        return b.select(*BASE_COLUMNS)

    @cached_property
    def base_long(self) -> DataFrame:
        return features.wide_to_long(self.base, ROW_COLS, BASE_CATEGORICAL, BASE_NUMERIC)

    def profile(self, kind: str) -> DataFrame:
        keep = self._stage if self.materialize_stages else None
        if kind == "area":
            return features.variable_profile(self.area_long, self.base, "ctx_id", keep=keep)
        return features.variable_profile(self.person_long, self.base, "patid", keep=keep)

    @cached_property
    def profiles(self) -> dict[str, DataFrame]:
        """Profiles written by kind, one row per variable: the features read them
        for the variables and, where they impute, for the values too."""
        return {}

    def kept_profile(self, kind: str) -> DataFrame:
        if kind not in self.profiles:
            self.profiles[kind] = self._stage(self.profile(kind), f"profile-{kind}")
        return self.profiles[kind]

    def attribute_features(self, kind: str, impute: bool = False) -> DataFrame:
        if kind == "area":
            return features.attribute_features(self.area_num, self.base, self.kept_profile("area"), F.col("rt") >= 0.5,
                                               person_key="ctx_id", attr_person="ctx_id", row_cols=ROW_COLS, impute=impute)
        return features.attribute_features(self.person_num, self.base, self.kept_profile("person"),
                                           (F.col("rt") >= 0.01) | (F.col("type") == "C"), person_key="patid",
                                           attr_person="patid", row_cols=ROW_COLS, impute=impute)

    def feature_long(self, *kinds: str, impute: bool = False) -> DataFrame:
        return features.feature_long(self.base_long, *[self.attribute_features(k, impute) for k in kinds], row_cols=ROW_COLS)

    @cached_property
    def features_all(self) -> DataFrame:
        """Base and both attribute feature sets, written once: the encoder,
        sparse rows, importance and shared-feature steps all read it."""
        return self._stage(self.feature_long("area", "person"), "features_all")


COHORT_COLUMNS = ["patid", "birth_date", "sex", "race", "hispanic", "enr_start", "enr_end", "ctx_id", "first_value",
                  "first_date", "age_at_enr_start", "enr_dur"]

# What the link, and the lookback and the label, add to an admission.
LINK_COLUMNS = ["encounterid_lead", "los", "days_to_next", "days_to_censor", "days_to_death"]
LOOKBACK_COLUMNS = ["n_prior_12m", "label"]
LABEL_COLUMNS = ["patid", "encounterid", "encounterid_lead", "enc_type", "drg", "admit_date", "discharge_date",
                 "discharge_status", "discharge_disposition", "los", "days_to_next", "days_to_censor",
                 "days_to_death", "n_prior_12m", "label"]
