"""Table formats, written down as data.

Every line of ``FIELDS`` is one detail table: its fields in log order, with
``:i`` for a whole number, ``:d`` for a one-place decimal and text otherwise.
``a|b`` accepts either spelling of a key and stores it under the first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: fields of the detail tables --------------------------------
FIELDS = {
    # members
    "dwd_member_regtype": "appkey appregurl bdp_uuid createtime isranreg regsource uid:i websiteid:i dt dn",
    "dwd_member": "ad_id:i birthday email fullname iconurl lastlogin mailaddr memberlevel paymoney phone qq "
                  "register regupdatetime uid:i unitname userip zipcode dt dn",
    "dwd_base_ad": "adid:i adname dn",
    "dwd_base_website": "siteid:i sitename siteurl delete:i createtime creator dn",
    "dwd_pcentermempaymoney": "paymoney uid:i vip_id:i siteid:i dt dn",
    "dwd_vip_level": "end_time last_modify_time max_free min_free next_level operator start_time "
                     "vip_id:i vip_level dn",
    # question bank
    "dwd_qz_chapter": "chapterid:i chapterlistid:i chaptername sequence showstatus status creator createtime "
                      "courseid:i chapternum:i outchapterid:i dt dn",
    "dwd_qz_chapter_list": "chapterlistid:i chapterlistname courseid:i chapterallnum:i sequence status creator "
                           "createtime dt dn",
    "dwd_qz_point": "pointid:i courseid:i pointname pointyear chapter creator createtime status modifystatus "
                    "excisenum:i pointlistid:i chapterid:i sequence|sequece pointdescribe pointlevel typelist "
                    "score:d thought remid pointnamelist typelistids pointlist dt dn",
    "dwd_qz_point_question": "pointid:i questionid:i questype:i creator createtime dt dn",
    "dwd_qz_site_course": "sitecourseid:i siteid:i courseid:i sitecoursename coursechapter sequence status creator "
                          "createtime helppaperstatus servertype boardid:i showstatus dt dn",
    "dwd_qz_course": "courseid:i majorid:i coursename coursechapter sequence|sequnece isadvc creator createtime "
                     "status chapterlistid:i pointlistid:i dt dn",
    "dwd_qz_course_edusubject": "courseeduid:i edusubjectid:i courseid:i creator createtime majorid:i dt dn",
    "dwd_qz_website": "siteid:i sitename domain sequence multicastserver templateserver status creator createtime "
                      "multicastgateway multicastport dt dn",
    "dwd_qz_major": "majorid:i businessid:i siteid:i majorname shortname status sequence creator createtime "
                    "columm_sitetype dt dn",
    "dwd_qz_business": "businessid:i businessname sequence status creator createtime siteid:i dt dn",
    "dwd_qz_paper_view": "paperviewid:i paperid:i paperviewname paperparam openstatus explainurl iscontest "
                         "contesttime conteststarttime contestendtime contesttimelimit dayiid:i status creator "
                         "createtime paperviewcatid:i modifystatus description papertype downurl paperuse "
                         "paperdifficult testreport paperuseshow dt dn",
    "dwd_qz_center_paper": "paperviewid:i centerid:i openstatus sequence creator createtime dt dn",
    "dwd_qz_paper": "paperid:i papercatid:i courseid:i paperyear chapter suitnum papername status creator "
                    "createtime totalscore:d chapterid:i chapterlistid:i dt dn",
    "dwd_qz_center": "centerid:i centername centeryear centertype openstatus centerparam description creator "
                     "createtime sequence provideuser centerviewtype stage dt dn",
    "dwd_qz_question": "questionid:i parentid:i questypeid:i quesviewtype:i content answer analysis limitminute "
                       "score:d splitscore:d status optnum:i lecture creator createtime modifystatus attanswer "
                       "questag vanalysisaddr difficulty quesskill vdeoaddr dt dn",
    "dwd_qz_question_type": "quesviewtype:i viewtypename questypeid:i description status creator createtime "
                            "papertypename sequence remark splitscoretype dt dn",
    "dwd_qz_member_paper_question": "userid:i paperviewid:i chapterid:i sitecourseid:i questionid:i majorid:i "
                                    "useranswer istrue lasttime opertype paperid:i spendtime:i score:d "
                                    "question_answer:i dt dn",
    # course sales
    "dwd_sale_course": "courseid coursename status pointlistid majorid chapterid chaptername edusubjectid "
                       "edusubjectname teacherid teachername coursemanager money dt dn",
    "dwd_course_pay": "orderid discount paymoney createtime dt dn",
    "dwd_course_shopping_cart": "courseid orderid coursename discount sellmoney createtime dt dn",
    "dwd_course_pay_cluster": "orderid discount paymoney createtime|createitme dt dn",
    "dwd_course_shopping_cart_cluster": "courseid orderid coursename discount sellmoney createtime dt dn",
    # lake and streams
    "lake_member": "uid:i ad_id:i fullname iconurl dt dn",
    "learn_event": "uid:i cwareid:i videoid:i chapterid:i edutypeid:i subjectid:i sourceType speed:i ts:l te:l "
                   "ps:i pe:i",
    "page_event": "uid:e app_id:e device_id:e ip:e last_page_id:e page_id:e next_page_id:e",
}

# fixed values: fields of the tab-separated stream lines
REGISTER_TSV = ["userid", "app_code", "registered_at"]
ANSWER_TSV = ["userid", "courseid", "pointid", "questionid", "istrue", "createtime"]

# fixed values: derived columns as (table, column, recipe, source column)
DERIVED = [
    ("dwd_member_regtype", "regsourcename", "register_source", "regsource"),
    ("dwd_member", "fullname", "mask_name", "fullname"),
    ("dwd_member", "phone", "mask_phone", "phone"),
    ("dwd_member", "password", "mask_const", None),
]

# fixed values: tables replaced on each load, log files whose name differs, tables bucketed by order
REPLACED = {"dwd_base_ad", "dwd_base_website", "dwd_vip_level"}
BUCKETED = {"dwd_course_pay_cluster": "orderid", "dwd_course_shopping_cart_cluster": "orderid"}
BUCKETS = 10
LOG_OF_CLUSTER = {"dwd_course_pay_cluster": "dwd_course_pay",
                  "dwd_course_shopping_cart_cluster": "dwd_course_shopping_cart"}

KINDS = {"i": "int", "d": "decimal", "l": "long", "e": "text_or_empty", "": "text"}


@dataclass(frozen=True)
class FieldSpec:
    name: str
    kind: str = "text"
    spellings: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[FieldSpec, ...]
    derived: tuple[tuple[str, str, str | None], ...] = ()
    mode: str = "append"
    partitions: tuple[str, ...] = field(default=("dt", "dn"))

    @property
    def columns(self) -> list[str]:
        names = [f.name for f in self.fields]
        extra = [d[0] for d in self.derived if d[0] not in names]
        tail = [p for p in self.partitions if p in names]
        return [n for n in names if n not in tail] + extra + tail


def parse_fields(text: str) -> tuple[FieldSpec, ...]:
    out = []
    for token in text.split():
        names, _, kind = token.partition(":")
        spellings = tuple(names.split("|"))
        out.append(FieldSpec(spellings[0], KINDS[kind], spellings))
    return tuple(out)


def spec(name: str) -> TableSpec:
    fields = parse_fields(FIELDS[name])
    present = [p for p in ("dt", "dn") if p in {f.name for f in fields}]
    return TableSpec(
        name=name,
        fields=fields,
        derived=tuple((c, r, s) for t, c, r, s in DERIVED if t == name),
        mode="overwrite" if name in REPLACED else "append",
        partitions=tuple(present),
    )


# --- fixed values: warehouse scans ---------------------------------------------
# scan name -> (table, columns); ``a>b`` reads a as b, ``a::type`` casts.
SCANS = {
    # members
    "member": ("dwd.dwd_member",
               "uid ad_id email fullname iconurl lastlogin mailaddr memberlevel password phone qq register "
               "regupdatetime unitname userip zipcode dt dn"),
    "member_regtype": ("dwd.dwd_member_regtype",
                       "uid appkey appregurl bdp_uuid createtime>reg_createtime isranreg regsource regsourcename "
                       "websiteid>siteid dn"),
    "base_ad": ("dwd.dwd_base_ad", "adid>ad_id adname dn"),
    "base_website": ("dwd.dwd_base_website",
                     "siteid sitename siteurl delete>site_delete createtime>site_createtime creator>site_creator dn"),
    "vip_level": ("dwd.dwd_vip_level",
                  "vip_id vip_level start_time>vip_start_time end_time>vip_end_time "
                  "last_modify_time>vip_last_modify_time max_free>vip_max_free min_free>vip_min_free "
                  "next_level>vip_next_level operator>vip_operator dn"),
    "member_payment": ("dwd.dwd_pcentermempaymoney", "uid paymoney::decimal(20,4) vip_id dn"),
    "member_wide": ("dws.dws_member",
                    "uid ad_id memberlevel register appregurl regsource regsourcename adname siteid sitename "
                    "vip_level paymoney::decimal(20,4) dt dn"),
    # question bank, detail layer
    "qz_chapter": ("dwd.dwd_qz_chapter",
                   "chapterid chapterlistid chaptername sequence showstatus status creator>chapter_creator "
                   "createtime>chapter_createtime courseid>chapter_courseid chapternum outchapterid dt dn"),
    "qz_chapter_list": ("dwd.dwd_qz_chapter_list", "chapterlistid chapterlistname chapterallnum dn"),
    "qz_point": ("dwd.dwd_qz_point",
                 "pointid pointname pointyear chapter excisenum pointlistid chapterid pointdescribe pointlevel "
                 "typelist score>point_score thought remid pointnamelist typelistids pointlist dn"),
    "qz_point_question": ("dwd.dwd_qz_point_question", "pointid questionid questype dn"),
    "qz_site_course": ("dwd.dwd_qz_site_course",
                       "sitecourseid siteid courseid sitecoursename coursechapter sequence status "
                       "creator>sitecourse_creator createtime>sitecourse_createtime helppaperstatus servertype "
                       "boardid showstatus dt dn"),
    "qz_course": ("dwd.dwd_qz_course", "courseid majorid coursename isadvc chapterlistid pointlistid dn"),
    "qz_course_edusubject": ("dwd.dwd_qz_course_edusubject", "courseeduid edusubjectid courseid dn"),
    "qz_major": ("dwd.dwd_qz_major",
                 "majorid businessid siteid majorname shortname status sequence creator>major_creator "
                 "createtime>major_createtime dt dn"),
    "qz_website": ("dwd.dwd_qz_website",
                   "siteid sitename domain multicastserver templateserver creator createtime multicastgateway "
                   "multicastport dn"),
    "qz_business": ("dwd.dwd_qz_business", "businessid businessname dn"),
    "qz_paper_view": ("dwd.dwd_qz_paper_view",
                      "paperviewid paperid paperviewname paperparam openstatus explainurl iscontest contesttime "
                      "conteststarttime contestendtime contesttimelimit dayiid status creator>paper_view_creator "
                      "createtime>paper_view_createtime paperviewcatid modifystatus description papertype downurl "
                      "paperuse paperdifficult testreport paperuseshow dt dn"),
    "qz_center_paper": ("dwd.dwd_qz_center_paper", "paperviewid sequence centerid dn"),
    "qz_paper": ("dwd.dwd_qz_paper",
                 "paperid papercatid courseid paperyear chapter suitnum papername totalscore chapterid "
                 "chapterlistid dn"),
    "qz_center": ("dwd.dwd_qz_center",
                  "centerid centername centeryear centertype centerparam provideuser centerviewtype stage dn"),
    "qz_question": ("dwd.dwd_qz_question",
                    "questionid parentid questypeid quesviewtype content answer analysis limitminute score "
                    "splitscore status optnum lecture creator createtime modifystatus attanswer questag "
                    "vanalysisaddr difficulty quesskill vdeoaddr dt dn"),
    "qz_question_type": ("dwd.dwd_qz_question_type",
                         "questypeid viewtypename description papertypename remark splitscoretype dn"),
    # question bank, inputs of the answer detail
    "answer": ("dwd.dwd_qz_member_paper_question",
               "userid paperviewid chapterid sitecourseid questionid majorid useranswer istrue lasttime opertype "
               "paperid spendtime score question_answer dt dn"),
    "answer_chapter": ("dws.dws_qz_chapter",
                       "chapterid chapterlistid chaptername sequence>chapter_sequence status>chapter_status "
                       "chapter_courseid chapternum chapterallnum outchapterid chapterlistname pointid questype "
                       "pointname pointyear chapter excisenum pointlistid pointdescribe pointlevel typelist "
                       "point_score thought remid pointnamelist typelistids pointlist dn"),
    "answer_course": ("dws.dws_qz_course",
                      "sitecourseid siteid courseid sitecoursename coursechapter sequence>course_sequence "
                      "status>course_status sitecourse_creator sitecourse_createtime helppaperstatus servertype "
                      "boardid showstatus majorid coursename isadvc chapterlistid pointlistid courseeduid "
                      "edusubjectid dn"),
    "answer_major": ("dws.dws_qz_major",
                     "majorid businessid majorname shortname status>major_status sequence>major_sequence "
                     "major_creator major_createtime businessname sitename domain multicastserver templateserver "
                     "multicastgateway multicastport dn"),
    "answer_paper": ("dws.dws_qz_paper",
                     "paperviewid paperid paperviewname paperparam openstatus explainurl iscontest contesttime "
                     "conteststarttime contestendtime contesttimelimit dayiid status>paper_status "
                     "paper_view_creator paper_view_createtime paperviewcatid modifystatus description paperuse "
                     "testreport centerid sequence>paper_sequence centername centeryear centertype provideuser "
                     "centerviewtype stage>paper_stage papercatid courseid paperyear suitnum papername totalscore "
                     "dn"),
    "answer_question": ("dws.dws_qz_question",
                        "questionid parentid>question_parentid questypeid quesviewtype content>question_content "
                        "answer>question_answer analysis>question_analysis limitminute>question_limitminute "
                        "score>question_score splitscore lecture creator>question_creator "
                        "createtime>question_createtime modifystatus>question_modifystatus "
                        "attanswer>question_attanswer questag>question_questag "
                        "vanalysisaddr>question_vanalysisaddr difficulty>question_difficulty quesskill vdeoaddr "
                        "description>question_description splitscoretype>question_splitscoretype dn"),
    # course sales
    "sale_course": ("dwd.dwd_sale_course",
                    "courseid coursename status pointlistid majorid chapterid chaptername edusubjectid "
                    "edusubjectname teacherid teachername coursemanager money dt dn"),
    "cart": ("dwd.dwd_course_shopping_cart", "courseid orderid coursename discount sellmoney createtime dt dn"),
    "cart_bucketed": ("dwd.dwd_course_shopping_cart_cluster",
                      "courseid orderid coursename discount sellmoney createtime dt dn"),
    "pay": ("dwd.dwd_course_pay", "orderid discount paymoney createtime dt dn"),
    "pay_bucketed": ("dwd.dwd_course_pay_cluster", "orderid discount paymoney createtime dt dn"),
}
