"""Schemas of the relations that sources give and sinks take."""

#: Unified message: CSV at rest, one file for each room.
UNIFIED_CSV = (
    "id bigint, MsgSvrID string, type_name string, is_sender int, talker string, msg string, src string, "
    "CreateTime string, room_name string, is_forward int"
)
#: Unified message as the engine holds it, with the order inside its file.
UNIFIED = (
    "id bigint, MsgSvrID string, type_name string, is_sender int, talker string, msg string, src string, "
    "CreateTime timestamp, room_name string, is_forward int, _file string, _seq bigint"
)
MESSAGE = "struct<role:string,content:string>"
DIALOGUE = f"messages array<{MESSAGE}>, images array<string>"
#: Any training or foreign question-answer record; absent fields are null.
RECORD = (
    f"messages array<{MESSAGE}>, images array<string>, conversations array<struct<`from`:string,value:string>>, "
    "turns array<struct<role:string,text:string>>, instruction string, input string, output string, text string, expected string"
)
SEGMENT = "role string, content string, timestamp struct<start:double,`end`:double>"
QQ_COLUMNS = ("40050", "40030", "40033", "40800")
QQ = "ts bigint, peer bigint, sender bigint, body binary"
WECHAT = "MsgSvrID string, IsSender int, CreateTime bigint, StrTalker string, StrContent string, Type int"
STREAMS = "streams array<struct<index:int,codec_type:string,codec_name:string,channels:string,sample_rate:string>>"
