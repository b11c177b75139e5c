"""Table schemas (DDL strings) of the engine's stored tables; ``checked`` holds
a table to its schema before it is written."""

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

RESOURCE_DDL = "struct<name:string,url:string,type:string,purpose:string>"

EDUCATIONAL_DDL = ("struct<summary:string,workflow:array<struct<step:string,tool:string,"
                   "detail:string>>,concepts:array<struct<term:string,explanation:string>>,"
                   "principles:array<string>,techniques:array<string>>")

ACTIONABLE_DDL = (f"struct<summary:string,resources:array<{RESOURCE_DDL}>,tools:array<string>,"
                  "guides:array<string>,downloads:array<struct<name:string,url:string>>>")

ANALYSIS_DDL = ("struct<is_educational:boolean,is_actionable:boolean,admirality:string,"
                "domain:string,subdomain:string,topic:string,subtopic:string,"
                "content_type:string,style:string,format:string,"
                f"educational_json:{EDUCATIONAL_DDL},actionable_json:{ACTIONABLE_DDL},"
                "transcript:string>")

GOLD_DDL = ("post_id string, schema_version int, status string, result " + ANALYSIS_DDL
            + ", error string, attempts int, analysed_at timestamp_ntz")

SILVER_DDL = ("post_id string, shortcode string, url string, caption string, owner_id string, "
              "owner_username string, likes_count bigint, comments_count bigint, "
              "video_play_count bigint, video_view_count bigint, timestamp timestamp_ntz, "
              "hashtags array<string>, meta_data variant, has_engagement_bait boolean, "
              "media_files array<string>, media_count int, source_dataset string, "
              "silvered_at timestamp_ntz")

PROFILE_DDL = ("profile_key bigint, owner_id string, owner_username string, "
               "follower_count bigint, posts_count_ig bigint, bio string, is_verified boolean, "
               "profile_category string, external_url string, related_profiles array<string>, "
               "effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")

MANIFEST_DDL = ("dataset_id string, landing string, run_id string, actor string, item_count bigint, "
                "downloaded_at timestamp_ntz")
PROGRESS_DDL = "source_dataset string, post_count bigint, completed_at timestamp_ntz"


def checked(df: DataFrame, ddl: str) -> DataFrame:
    """``df``, if it has the schema's columns in its types (more may follow); an error otherwise."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = {f.name: (f.dataType.simpleString(), have.get(f.name)) for f in StructType.fromDDL(ddl).fields
             if have.get(f.name) != f.dataType.simpleString()}
    if wrong:
        raise ValueError(f"columns (wanted, found): {wrong}")
    return df
