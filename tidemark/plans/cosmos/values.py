"""Names, types and addresses that occur in the payloads."""

# first signer of a transaction: (message type, attribute)
SENDER_SOURCES = [("tx", "acc_seq"), ("signer", "sei_addr")]
NATIVE_ADDRESS_KEY = "sei_addr"
EVM_ADDRESS_KEY = "evm_addr"
NATIVE_TRANSFER = "SEI"
ZERO_FEE = "0usei"
ORACLE_VOTE_ACTION = "/seiprotocol.seichain.oracle.MsgAggregateExchangeRateVote"
GOV_VOTE_ACTION = "/cosmos.gov.v1beta1.MsgVote"
CHAIN = "sei"
PRICE_ID = "sei-network"
NATIVE_SYMBOL = "SEI"
PAIR_FACTORY = "sei1xr3rq8yvd7qplsw5yx90ftsr2zdhg4e9z60h5duusgxpv72hud3shh3qfl"
BRIDGE_CONTRACT = "sei1smzlm9t79kur392nu9egl8p8je9j92q4gzguewj56a05kyxxra0qy0nuf3"
MARKET_ONE = "sei152u2u0lqc27428cuf8dx48k8saua74m6nql5kgvsu4rfeqm547rsnhy4y9"
MARKET_TWO = "sei1pdwlx9h8nc3fp6073mweug654wfkxjaelgkum0a9wtsktwuydw5sduczvz"
COLLATERAL_DECIMALS = {
    "sei14j7zhcj50qsk6vhu7dsa48r5e7v37nthnwwx0q8q4nd0h39udy6qhqq6dm": 6,
    "sei1jvl8avv45sj92q9x9c84fq2ymddya6dkwv9euf7y365tkzma38zq5xldpy": 8,
}
EPOCH_STAMP = "2000-01-01 00:00:00"
