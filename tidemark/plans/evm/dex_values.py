"""Factories, topics and display names of exchanges."""

PAIR_CREATED = "0x0d3648bd0f6ba80134a33ba9275ac585d9d315f0ad8355cddefde31afa28d0e9"
POOL_CREATED = "0x783cca1c0412dd0d695e784568c96da2e9c22ff989357a2e8b1d9b2b4e6b7118"
SWAP_V2 = "0xd78ad95fa46c994b6551d0da85fc275fe613ce37657fb8d5e3d130840159d822"
SWAP_V3 = "0xc42079f94a6350d7e6235f29174924f928cc2ac818eb64fed8004e115fbcca67"
POOL_REGISTERED = "0x3c13bc30b8e878c53fd2a36b679409c073afd75950be43d8858768e956fbc20e"
TOKENS_REGISTERED = "0xf5847d3f2197b16cdcd2098ec95d0905cd1abdaf415f07bb7cef2bba8ac5dec4"
VAULT_SWAP = "0x2170c741c41531aec20e7c107c24eecfdd15e69c9bb0a8dd37b1840b9e0b207b"

# factory, protocol, version, type
PAIR_FACTORIES = [
    ("0x595a6b190ba0163eac1da988955563635ab3aa60", "uniswap", "v2", "uni_v2_pair_created"),
    ("0x4b4746216214f9e972c5d35d3fe88e6ec4c28a6b", "donkeswap", "v2", "uni_v2_pair_created"),
    ("0x5d370a6189f89603fab67e9c68383e63f7b6a262", "dragonswap", "v1", "uni_v2_pair_created"),
    ("0x71b27deea549cf3e9293544b2af7a193a34be29a", "dragonswap", "v1", "uni_v2_pair_created"),
]
POOL_FACTORIES = [
    ("0x3976ccb6603f4af4f1f21ac1ac993e3776b8d590", "uniswap", "v3", "uni_v3_pool_created"),
    ("0x385488ffbff2265dac31d38497b616fa6cc81231", "uniswap", "v3", "uni_v3_pool_created"),
    ("0x75fc67473a91335b5b8f8821277262a13b38c9b3", "uniswap", "v3", "uni_v3_pool_created"),
    ("0x23f1822ede8b1fa63c1652c2212a74481a6e6130", "uniswap", "v3", "uni_v3_pool_created"),
    ("0x179d9a5592bc77050796f7be28058c51ca575df4", "dragonswap", "v2", "uni_v3_pool_created"),
    ("0x0bcea088e977a03113a880cf7c5b6165d8304b16", "dragonswap", "v2", "uni_v3_pool_created"),
    ("0x0596a0469d5452f876523487251bdde73d4b2597", "xei", "v3", "uni_v3_pool_created"),
    ("0xdde4ff846706236eaae4367fff233c0e35a0613f", "yeiswap", "v1", "uni_v3_pool_created"),
    ("0xa51136931fdd3875902618bf6b3abe38ab2d703b", "sailor", "v1", "uni_v3_pool_created"),
    ("0x0a6816112d8fd84ae2111ab23a7e524865d923c5", "sailor", "v1", "uni_v3_pool_created"),
]
VAULTS = [("0xfb43069f6d0473b85686a85f4ce4fc1fd8f00875", "jellyswap", "v1", "balancer_pool_created")]

# platform → ending of the pool name
FEE_SUFFIX = {"uniswap-v3": "UNI-V3 LP", "dragonswap-v2": "DRAGON-V2 LP"}
MANY_TOKENS = "jellyswap-v1"
HOOKED = "uniswap-v4"
HOOKED_SUFFIX = "UNI-V4 LP"
NO_POOL_ID = "0x"
COIN_SYMBOL = "SEI"
MAX_TOKENS = 8
READ_BATCH = 250
