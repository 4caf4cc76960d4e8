"""Event topics, function selectors and addresses."""

WRAPPED_NATIVE = "0xe30fedd158a2e3b13e9badaeabafc5516e95e8c7"
ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"
TRANSFER = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
TRANSFER_SINGLE = "0xc3d58168c5ae7397731d063d5bbf3d657854427343f4c083240f7aacaa2d0f62"
TRANSFER_BATCH = "0x4a39dc06d4c0dbc64b70af90fd698a233a518aa5d07e595d983b8c0526c8f7fb"
READ_NAME = "0x06fdde03"
READ_SYMBOL = "0x95d89b41"
READ_DECIMALS = "0x313ce567"
# longest answer still taken for a name or symbol
READ_LIMIT = 4300
NETWORK = "mainnet"
