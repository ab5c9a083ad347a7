"""Vocabularies as data. Every rule of the library takes its words from a Lexicon, so another domain needs no code.

The default vocabulary is that of one regulated consumer industry in Chinese and English. Patterns are Java regular
expressions; `(?i)` is added where letters of either case count.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: names, lists and patterns that have to be equal for equal results ---------------------------------

MODULES = ["广告合规及处罚案例", "美妆动态", "知识产权动态", "新规及案例动态", "进出口动态", "产品质量/召回与安全风险"]
MODULE_ALIASES = {"广告处罚案例": "广告合规及处罚案例", "知识产权保护或者侵权": "知识产权动态", "新法律法规政策": "新规及案例动态", "进出口": "进出口动态"}
CARD_MODULES = ["新法律法规政策", "广告处罚案例", "知识产权保护或者侵权", "进出口", "产品质量/召回与安全风险", "美妆动态"]
CARD_MODULE_ALIASES = {"新规及案例动态": "新法律法规政策", "广告合规及处罚案例": "广告处罚案例", "知识产权动态": "知识产权保护或者侵权", "进出口动态": "进出口"}
DISPLAY_MODULES = ["新法律法规政策", "广告处罚案例", "知识产权保护与侵权", "进出口", "行业新闻简讯"]
FUNNEL_STAGES = ["discovered", "resolved_original", "hydrated_with_substantive_text", "hard_fact_ready", "editorial_accepted", "ai_accepted", "premium_selectable", "final"]

TRACKING_KEYS = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "scm", "spm", "from", "source", "ref", "refer", "referer", "scroll", "cid", "clicktime", "clickid", "wt", "at", "pvid", "tok"]
MOBILE_LABELS = ["m", "mobile", "wap", "3g", "www", "mt", "it", "i", "3w", "app", "touch"]
PATH_ALIASES = {r"nifdc\.org\.cn$": "/directory/web/"}
MEDIA_TYPES = ["industry_media", "media", "wechat_lead", "wechat_public_account"]
OFFICIAL_TYPES = ["official", "official_site", "regulator", "court", "database"]
EMPTY_OBSERVATIONS = ["建议关注", "持续关注", "提高重视", "加强管理", "企业应留意", "可能产生影响"]
FACT_FIELDS = ["authority", "document_number", "involved_party", "violation_behavior", "penalty_amount", "confiscation_result", "legal_basis", "product_or_batch", "hs_code", "effective_date", "deadline", "feedback_channel"]

FRESH_DAYS, EXCEPTION_DAYS, SEEN_DAYS, FINGERPRINT_DAYS = 15, 90, 60, 30
MIN_ARTICLE, MAX_ARTICLE = 240, 120_000

DOMAIN = r"(?i)化妆品|美妆|护肤|彩妆|香水|防晒|洗护|牙膏|化妆品原料|香料香精|功效宣称|功效评价|美容仪器|cosmetic|cosmetics|skincare|sunscreen|beauty\s+(?:product|brand|industry)"
PROMOTION_SERVICE = r"(?i)双清包税|一站式(?:代办|服务)|包税到门|物流专线"
PROMOTION = [
    r"(?i)企业供稿",
    r"(?i)全球招展|报名参展|招商|招代理|欢迎合作|欢迎报名",
    PROMOTION_SERVICE,
    r"(?i)新品发布|品牌宣传|重磅上市|开启.*体验|打造.*实力",
    r"(?i)产品推荐|十大.*推荐|品牌实力(?:榜单|推荐)|实测(?:分级)?榜单|盘点.*好物|选购指南",
]
OPINION = [r"(?i)行业观察|趋势分析|增长逻辑|长期成长路径|重新分配.*增长", r"(?i)建议关注|持续关注|可能产生影响|企业应留意|未来竞争"]
ACTION = (
    r"(?i)发布|公布|通报|处罚|罚款|召回|下架|查处|判决|裁定|签订|签署|推出|启动|布局|出口|进口|实施|生效|修订|征求意见|备案|注册|清算|要求|禁止|限制|调整|超标|发现|调查|取缔|赔偿|上市|"
    r"announc(?:e|ed|es)|deploy(?:s|ed)?|implement(?:s|ed)?|issu(?:e|ed|es)|file(?:s|d)?|rule(?:s|d)?|recall(?:s|ed)?|destroy(?:s|ed)?|abolish(?:es|ed)?|require(?:s|d)?|ban(?:s|ned)?|inspect(?:s|ed)?"
)
ACTOR = (
    r"(?i)(?:国家|省|市|县|区)?[一-鿿A-Za-z0-9]{2,}(?:局|委|院|署|海关|法院|公司|集团|企业|品牌|平台|电商|银行|协会|政府|部门|监管机构|NMPA|BPOM|FDA|MFDS|EUIPO|FTC|Court|Commission|Authority|Ministry|Government|Agency|Company|Group|Platform)"
    r"|监管部门|法院|海关|公司|集团|品牌|企业|平台|电商|government|court|commission|authority|ministry|\bFDA\b|task force"
)
EVIDENCE = (
    r"(?i)20\d{2}[年./-]\d{1,2}[月./-]\d{1,2}日?|20\d{2}년\s*\d{1,2}월\s*\d{1,2}일|(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s+20\d{2}|"
    r"\d+(?:\.\d+)?\s*(?:万|亿|元|美元|欧元|件|批|吨|天|个|家|%|％|batches?|products?)|罚款|处罚|召回|备案|注册|规则|条例|通知|判决|裁定|进出口|征求意见|生效|禁用|限用|抽检|不合格|超标|清算|"
    r"regulation|standard|judgment|ruling|recall|penalty|prosecution|task force|inspection|banned?"
)
HARD_EVENT_WORDS = r"(?i)处罚|罚款|召回|下架|判决|裁定|赔偿|侵权|商标|专利|海关|进口|出口|清关|HS\s*编码|虚假宣传|功效宣称|抽检|不合格|禁用成分|治理"
OPINION_EXEMPTION = r"处罚|召回|判决|通报|签订|出口|进口|备案|注册|抽检|清算|罚款"
HOME_MARKERS = [
    r"(?i)中国|中华人民共和国|中国大陆|国内市场|中国市场|在华|对华|输华|中国出口|中国进口",
    r"(?i)国家药监局|国家市场监管总局|海关总署|中国海关|国家知识产权局|中国法院|中国证监会|China\s+NMPA",
    r"(?i)北京|上海|天津|重庆|广州|深圳|杭州|南京|苏州|成都|武汉|西安|厦门|宁波|青岛|郑州|合肥|济南|福州|昆明|沈阳|大连|浙江|江苏|广东|福建|四川|湖北|山东|河北|河南|湖南|安徽|陕西|云南|辽宁|澳门|香港",
    r"(?i)影响在中国市场|影响中国企业|中国企业|中国消费者|中国境内",
]
HOME_COUNTRY = "中国"
SHELL_LINE = r"(?i)^(?:首页|导航|登录|注册|联系我们|搜索|移动版|客户端|分享|打印|字体大小|English|Home|Menu|关闭|上一页|下一页|订阅|欢迎访问)"
NAVIGATION_TITLE = r"(?i)信息源入口|首页|主页|导航|登录|注册|联系我们|网站地图|搜索结果|welcome\s+to|site\s+map|contact\s+us"
REPUBLISHER_HOST = r"(?i)(?:^|\.)(?:(?:sohu|163|sina|qq|toutiao|baijiahao|thepaper|jiemian|36kr)\.com|(?:baijiahao|mp)\.baidu\.com)$"
REPUBLISHER_NAME = r"搜狐|转载|综合自|公众号线索"
AGGREGATOR_HOST = r"(?i)(?:^|\.)news\.google\.com$"
LEAD_HOST = r"(?i)(?:sohu|163|sina|qq|toutiao|baijiahao|mp\.baidu)\.com$"
PRIMARY_HOST = r"(?i)(?:gov\.cn|court\.gov\.cn|customs\.gov\.cn|fda\.gov|ftc\.gov|europa\.eu|gov\.uk|wipo\.int)$"
ACCESS_PAGE = r"(?i)sign\s*in|log\s*in|login required|access denied|forbidden|captcha|enable javascript|javascript required|pdf\.js|document viewer|not found|404|页面不存在|登录|验证码|访问被拒绝|未找到|错误页面"
MODULE_RULES = [  # the first that fits a title, then a body
    (r"召回|抽检|不符合规定|不合格|安全风险|禁用成分|限用成分|重金属|菌落|微生物|过敏|超标|停止销售", "产品质量/召回与安全风险"),
    (r"商标|专利|著作权|知识产权|侵权|判决|裁定|赔偿", "知识产权动态"),
    (r"(?:广告|虚假宣传|功效宣称|直播).*(?:处罚|罚款|查处|取缔)|(?:处罚|罚款|查处|取缔).*(?:广告|虚假宣传|功效宣称|直播)", "广告合规及处罚案例"),
    (r"法规|条例|征求意见|备案|注册|规则|标准|技术规范|管理办法|实施|生效|修订", "新规及案例动态"),
    (r"(?i)进出口|出口|进口|海关|清关|关税|报关|跨境|口岸|HS\s*编码", "进出口动态"),
    (r"行政处罚|处罚决定|罚款|查处|取缔", "广告合规及处罚案例"),
]
DEFAULT_MODULE = "美妆动态"
DISCOVERY_EVENTS = {
    "广告合规及处罚案例": r"(?i)处罚|罚款|没收|虚假宣传|广告违法|功效宣称|刷单|反不正当竞争|penalty|fine|advertising",
    "知识产权动态": r"(?i)商标|专利|著作权|侵权|仿冒|包装装潢|不正当竞争|判决|诉讼|赔偿|trademark|patent|infringement|lawsuit",
    "新规及案例动态": r"(?i)法规|办法|条例|标准|征求意见|备案|注册|指导原则|公告|实施|policy|regulation|standard|guidance",
    "产品质量/召回与安全风险": r"(?i)召回|不合格|抽检|检出|禁用|批次|质量安全|风险通报|污染|recall|contamination|safety alert",
    "进出口动态": r"(?i)海关|进口|出口|清关|扣留|退运|通关|跨境|进口预警|customs|import|export|seizure|import alert",
    "美妆动态": r"(?i)平台规则|平台治理|公告|通知|合规|下架|禁售|调整|新规|执法|调查|整改|数据泄露|停产|停业|许可证|电商|网售|网络销售|直播|店铺|商家|质量抽检|不合格|policy|rule|enforcement|investigation|compliance|ecommerce",
}
DISCOVERY_DEFAULT_EVENT = r"(?i)处罚|规则|公告|召回|侵权|海关"
DISCOVERY_PROMOTION = r"(?i)招商|加盟|新品上市|品牌推荐|十大|排行榜|促销|折扣|代购|选购指南"
DISCOVERY_DOMAIN = r"(?i)化妆品|美妆|护肤|彩妆|香水|防晒|染发|洗护|cosmetic|beauty|skincare"

PAGE_CONTROLS = r"(?i)下载|打印|关闭窗口|字体(?:大小)?|字号|分享到(?:新浪微博|QQ空间|微信|微博)|分享至(?:新浪微博|QQ空间|微信|微博)|收藏本站|返回顶部|视窗|最小化|最大化|还原|loading\.{3}|无障碍|关怀版|繁體|简体|EN(?:\s*$)|扫一扫|复制链接|打开适老|聽|请听|我在听|说话\(|網站地圖"
PAGE_SHELL = r"(?i)^(?:网站首页|首页|主页|当前位置|导航|站点导航|机构概况|信息公开|办事大厅|新闻中心|通知公告|联系我们|登录|注册|搜索|高级检索|友情链接|上一页|下一页|English|Home|Menu|X\b|用户空间|海关电邮|守国门|促发展)(?:\s|[>＞|｜:：/·-]|$)"
EVENT_WORDS = r"(?i)发布|公布|公告|通告|通报|征求意见|实施|生效|处罚|罚款|罚没|没收|召回|停止销售|抽检|不合格|判决|裁定|侵权|冒用|假冒|商标|专利|著作权|虚假宣传|功效宣称|平台治理|专项治理|治理公告|海关|关税|报关|清关|进口|出口|标准|法规|条例|办法|规定|备案|注册"
NAVIGATION_WORDS = r"(?i)新闻发布厅|时政要闻|媒体聚焦|快捷检索|高级检索|友情链接|返回顶部|上一篇|下一篇|机构|新闻|政务|服务|互动|专题|总局|司局|地方|图片|视频|当|好|让|党|放心"
SUBSTANCE_WORDS = r"发布|公布|通报|征求意见|实施|生效|处罚|罚款|罚没|没收|召回|停止销售|抽检|不合格|判决|裁定|侵权|虚假宣传|功效宣称|平台治理|专项治理|调整|修订|要求|决定"
GENERIC_INTRO = r"引发关注|备受关注|引起热议|引发热议|受到关注|引发讨论|引人注目"
SHARE_WORDS = "新浪微博|QQ空间|微信|微博|复制链接"

OBSERVED_DOMAIN = r"(?i)化妆品|美妆|护肤|彩妆|香水|防晒|洗护|面霜|眼霜|精华液?|面膜|爽肤水|化妆水|卸妆|洁面|洗面奶|口红|唇釉|气垫霜?|粉底液?|粉饼|散粉|睫毛膏|眼影|眼线|眉笔|腮红|染发剂?|烫发|洗发|护发|沐浴|牙膏|功效宣称|cosmetic|beauty|skincare|skin care|sunscreen|eye cream|foundation|lipstick|mascara|hair dye"
TITLE_STOP = r"关于|发布|公告|通知|最新|本周|化妆品|美妆|监管"
OWNERS = r"法务|合规|法规|质量|研发|供应链|采购|电商|广告|品牌|市场|知识产权|IP|进出口|关务|注册|备案|产品|渠道|海外|本地团队"

# --- End of fixed values ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Lexicon:
    """The words one set of rules goes by."""

    modules: list[str] = field(default_factory=lambda: list(MODULES))
    aliases: dict[str, str] = field(default_factory=lambda: dict(MODULE_ALIASES))
    domain: str = DOMAIN
    promotion: list[str] = field(default_factory=lambda: list(PROMOTION))
    opinion: list[str] = field(default_factory=lambda: list(OPINION))
    action: str = ACTION
    actor: str = ACTOR
    evidence: str = EVIDENCE
    module_rules: list[tuple[str, str]] = field(default_factory=lambda: list(MODULE_RULES))
    default_module: str = DEFAULT_MODULE
    home_markers: list[str] = field(default_factory=lambda: list(HOME_MARKERS))
    home_country: str = HOME_COUNTRY
    navigation_title: str = NAVIGATION_TITLE
    event_words: str = EVENT_WORDS


DEFAULT = Lexicon()
