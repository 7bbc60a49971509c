"""Names of the channel and message kinds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kind code -> name, as the public chat API numbers them.
CHANNEL_KINDS: dict[int, str] = {
    0: "Text",
    1: "Private",
    2: "Voice",
    3: "GroupDm",
    4: "Category",
    5: "News",
    10: "NewsThread",
    11: "PublicThread",
    12: "PrivateThread",
    13: "Stage",
    14: "Directory",
    15: "Forum",
}

MESSAGE_KINDS: dict[int, str] = {
    0: "Regular",
    1: "GroupRecipientAddition",
    2: "GroupRecipientRemoval",
    3: "GroupCallCreation",
    4: "GroupNameUpdate",
    5: "GroupIconUpdate",
    6: "PinsAdd",
    7: "MemberJoin",
    8: "NitroBoost",
    9: "NitroTier1",
    10: "NitroTier2",
    11: "NitroTier3",
    12: "ChannelFollowAdd",
    14: "GuildDiscoveryDisqualified",
    15: "GuildDiscoveryRequalified",
    16: "GuildDiscoveryGracePeriodInitialWarning",
    17: "GuildDiscoveryGracePeriodFinalWarning",
    18: "ThreadCreated",
    19: "InlineReply",
    20: "ChatInputCommand",
    21: "ThreadStarterMessage",
    22: "GuildInviteReminder",
    23: "ContextMenuCommand",
    24: "AutoModAction",
    25: "RoleSubscriptionPurchase",
    26: "InteractionPremiumUpsell",
    27: "StageStart",
    28: "StageEnd",
    29: "StageSpeaker",
    31: "StageTopic",
    32: "GuildApplicationPremiumSubscription",
}

# The kinds of channel that carry messages.
MESSAGE_BEARING_KINDS = (
    "Text",
    "News",
    "PublicThread",
    "PrivateThread",
    "NewsThread",
    "Forum",
)


def kind_name(kind: Column, names: Mapping[int, str]) -> Column:
    """Kind code or name -> name; a code outside ``names`` becomes ``Unknown(<code>)``.

    The table is a few dozen fixed entries, so it travels as a literal inside the expression and
    needs no join.
    """
    code = kind.try_cast("bigint")
    entries = ", ".join(f"{number}L, '{name}'" for number, name in names.items())
    table = F.expr(f"map({entries})")
    unknown = F.concat(F.lit("Unknown("), code.cast("string"), F.lit(")"))
    return F.when(code.isNull(), kind).otherwise(F.coalesce(F.try_element_at(table, code), unknown))
