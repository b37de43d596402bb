"""Table layouts, as Spark DDL."""

LANDING_REQUIRED = ("Title", "Content", "URL", "Rating")
LANDING_OPTIONAL = ("Date", "Verified Purchase", "Helpful", "Vine Voice", "Variant", "Images", "Videos")

REVIEW_RAW = (
    "Review_Key STRING, Review_ID STRING, ASIN STRING, Rating BIGINT, Title STRING, Content STRING, "
    "Clean_Text STRING, URL STRING, Review_Date DATE, Verified STRING, Helpful_Votes BIGINT, "
    "Variant STRING, Vine STRING, Images STRING, Videos STRING, Source_File STRING, ETL_Time TIMESTAMP"
)

FEATURE_TABLES = {
    "review_processing": (
        "Review_ID STRING NOT NULL, Model_Version STRING, Processed_Time TIMESTAMP, "
        "Processing_Status STRING, Error_Message STRING"
    ),
    "review_features": "Review_ID STRING NOT NULL, Keywords STRING",
    "scene_bridge": "Review_ID STRING, Main_Scene STRING, Sub_Scene STRING",
    "friction_bridge": (
        "Review_ID STRING, Friction_Main STRING, Friction_Sub STRING, Friction_Source STRING, "
        "Friction_Score DOUBLE, Friction_Margin DOUBLE"
    ),
    "motivation_bridge": (
        "Review_ID STRING, Motivation_Main STRING, Motivation_Sub STRING, Motivation_Source STRING, "
        "Motivation_Score DOUBLE, Motivation_Margin DOUBLE"
    ),
    "time_bridge": "Review_ID STRING, Time_of_Day STRING",
    "location_bridge": "Review_ID STRING, Location STRING",
}
BRIDGES = ("scene_bridge", "friction_bridge", "motivation_bridge", "time_bridge", "location_bridge")


# Listing export: header in the file (fixed values) -> our column name and type. Percentages are doubles.
LISTING_COLUMNS = (
    ("ASIN", "asin", "STRING"),
    ("品牌", "brand", "STRING"),
    ("商品标题", "title", "STRING"),
    ("产品卖点", "bullets", "STRING"),
    ("父ASIN", "parent_asin", "STRING"),
    ("类目路径", "category_path", "STRING"),
    ("大类目", "main_category", "STRING"),
    ("大类BSR", "main_rank", "BIGINT"),
    ("大类BSR增长数", "main_rank_change", "BIGINT"),
    ("大类BSR增长率", "main_rank_growth", "DOUBLE"),
    ("小类目", "sub_category", "STRING"),
    ("小类BSR", "sub_rank", "BIGINT"),
    ("月销量", "monthly_units", "BIGINT"),
    ("月销量增长率", "monthly_units_growth", "DOUBLE"),
    ("月销售额($)", "monthly_revenue", "BIGINT"),
    ("子体销量", "child_units", "BIGINT"),
    ("子体销售额($)", "child_revenue", "DOUBLE"),
    ("变体数", "variant_count", "BIGINT"),
    ("价格($)", "price", "DOUBLE"),
    ("Q&A数", "qa_count", "BIGINT"),
    ("评分数", "rating_count", "BIGINT"),
    ("月新增评分数", "new_ratings", "BIGINT"),
    ("评分", "rating", "DOUBLE"),
    ("留评率", "review_rate", "DOUBLE"),
    ("FBA($)", "fba_fee", "DOUBLE"),
    ("毛利率", "gross_margin", "DOUBLE"),
    ("上架时间", "listing_date", "DATE"),
    ("上架天数", "days_listed", "BIGINT"),
    ("配送方式", "fulfilment", "STRING"),
    ("买家运费($)", "buyer_shipping", "DOUBLE"),
    ("LQS", "lqs", "DOUBLE"),
    ("卖家数", "seller_count", "BIGINT"),
    ("卖家所属地", "seller_region", "STRING"),
    ("Best Seller标识", "best_seller", "STRING"),
    ("Amazon's Choice", "store_choice", "STRING"),
    ("CPF绿标", "green_label", "STRING"),
    ("CPF绿标信息", "green_label_info", "STRING"),
    ("New Release标识", "new_release", "STRING"),
    ("A+页面", "rich_page", "STRING"),
    ("视频介绍", "video_intro", "STRING"),
    ("SP广告", "sponsored_ad", "STRING"),
    ("品牌故事", "brand_story", "STRING"),
    ("品牌广告", "brand_ad", "STRING"),
    ("7天促销", "promo_7d", "STRING"),
    ("AC关键词", "choice_keywords", "STRING"),
    ("商品重量", "item_weight", "STRING"),
    ("商品重量（单位换算）", "item_weight_metric", "STRING"),
    ("商品尺寸", "item_size", "STRING"),
    ("商品尺寸（单位换算）", "item_size_metric", "STRING"),
    ("包装重量", "package_weight", "STRING"),
    ("包装重量（单位换算）", "package_weight_metric", "STRING"),
    ("包装尺寸", "package_size", "STRING"),
    ("包装尺寸（单位换算）", "package_size_metric", "STRING"),
    ("包装尺寸分段", "package_size_tier", "STRING"),
)
